"""Quality classifier: similarity-weighted vote of the nearest labelled documents.

A document's features are hashed words and triples of character kinds (small letter,
capital, digit, line end, space, each ASCII sign by itself), log-scaled and weighted by rarity.
A truncated singular value decomposition of the labelled documents gives a latent space;
their vectors there and the projection into it are broadcast, and every document is held
against all of them in blocks of exact cosine products.

The labelled documents are a bounded sample, ``PER_CLASS`` of each label at most, taken in the
order of a hash of doc_id.  Votes are weighted so that both labels keep the share they have
among all labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stmtscope.llm.scratch import share, shared_value
from stmtscope.llm.words import chunks, words_of

WORD_SLOTS, KIND_SLOTS = 3072, 1024
SLOTS = WORD_SLOTS + KIND_SLOTS
PER_CLASS = 2048
SIZE = 64  # of the latent vectors
NEIGHBOURS = 15
POWER = 4  # of the similarity, as weight of a vote
BLOCK = 512  # documents held against the labelled ones at once


def _kinds() -> np.ndarray:
    kinds = np.full(256, 1, np.uint8)  # small letters, and bytes of other characters
    signs = 6
    for b in range(128):
        c = chr(b)
        if c.isupper():
            kinds[b] = 2
        elif c.isdigit():
            kinds[b] = 3
        elif c == "\n":
            kinds[b] = 4
        elif c.isspace() or b < 32:
            kinds[b] = 5
        elif not c.islower():
            kinds[b] = signs
            signs += 1
    return kinds


KINDS = _kinds()
N_KINDS = int(KINDS.max()) + 1


def features(batch: pa.RecordBatch, words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, slot and count of each feature, ordered by text and slot."""
    text = batch.column("text").cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    kinds = KINDS[np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]].astype(np.int64)
    offsets = offsets - offsets[0]
    n = len(text)
    found = [words.text_of * SLOTS + (words.hash % np.uint64(WORD_SLOTS)).astype(np.int64)]
    if len(kinds) > 2:
        triples = (kinds[:-2] * N_KINDS + kinds[1:-1]) * N_KINDS + kinds[2:]
        slots = triples * 0x9E3779B1 % 0xFFFFFFFB % KIND_SLOTS + WORD_SLOTS
        owner = np.repeat(np.arange(n), np.diff(offsets))
        inside = owner[:-2] == owner[2:]
        found.append((owner[:-2] * SLOTS + slots)[inside])
    counts = np.bincount(np.concatenate(found), minlength=n * SLOTS)
    at = np.flatnonzero(counts)
    return at // SLOTS, at % SLOTS, counts[at]


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, words in chunks(batches):
        for begin, part, own in blocks(batch, words):
            text, slot, n = features(part, own)
            offsets = pa.array(np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("quality"),
                    pa.ListArray.from_arrays(offsets, pa.array(slot.astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int32))),
                ],
                names=["quality", "slots", "counts"],
            )


def blocks(batch: pa.RecordBatch, words):
    if len(batch) <= BLOCK:
        yield 0, batch, words
        return
    for begin in range(0, len(batch), BLOCK):
        part = batch.slice(begin, BLOCK)
        yield begin, part, words_of(part.column("text"))


@dataclass
class Model:
    rarity: np.ndarray  # of each slot
    projection: np.ndarray  # SLOTS x SIZE
    vectors: np.ndarray  # of the labelled documents, unit length
    votes: np.ndarray  # weight of each labelled document
    good: np.ndarray  # its label, 0 or 1
    prior: float  # share of label 1

    def latent(self, n: int, text: np.ndarray, slot: np.ndarray, count: np.ndarray) -> np.ndarray:
        x = np.zeros((n, SLOTS), np.float32)
        x[text, slot] = np.log1p(count) * self.rarity[slot]
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        z = x @ self.projection
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, z: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled documents."""
        if not len(self.vectors):
            return np.full(len(z), self.prior)
        similar = z @ self.vectors.T
        k = min(NEIGHBOURS, len(self.vectors))
        near = np.argpartition(similar, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(similar, near, axis=1), 0) ** POWER * self.votes[near]
        # The prior counts as a very small vote, so that a text like no other gets it.
        return ((weight * self.good[near]).sum(axis=1) + 1e-6 * self.prior) / (weight.sum(axis=1) + 1e-6)


def fit(good: np.ndarray, text: np.ndarray, slot: np.ndarray, count: np.ndarray, shares: np.ndarray) -> Model:
    """From the features of the labelled documents; ``shares`` of labels 0 and 1 in all."""
    n = len(good)
    spread = np.bincount(slot, minlength=SLOTS)
    rarity = np.log((1 + n) / (1 + spread)).astype(np.float32) + 1
    prior = float(shares[1]) if n else 0.5
    model = Model(rarity, np.eye(SLOTS, SIZE, dtype=np.float32), np.zeros((0, SIZE), np.float32), np.zeros(0), good, prior)
    if not n:
        return model
    x = np.zeros((n, SLOTS), np.float32)
    x[text, slot] = np.log1p(count) * rarity[slot]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    # Randomised decomposition: a few rounds of products find the leading directions.
    basis = np.random.default_rng(3).normal(size=(SLOTS, SIZE)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, directions = np.linalg.svd(x @ basis, full_matrices=False)
    model.projection = (basis @ directions.T).astype(np.float32)
    model.vectors = model.latent(n, text, slot, count)
    own = np.bincount(good, minlength=2) / n
    model.votes = shares[good] / own[good]
    return model


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """``docs`` (doc_id, text) and ``labels`` (doc_id, quality) that may be learned from."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", "quality")
    sizes = dict(known.groupBy("quality").count().collect())
    # The first rows of a sorted table: every task passes on no more than PER_CLASS of each class.
    classes = [known.where(F.col("quality") == c).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS) for c in (0, 1)]
    sample = classes[0].union(classes[1])
    # One text for each label, the smallest if a doc_id has several: at most 2 * PER_CLASS rows.
    chosen = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = chosen.select("quality", "text").mapInArrow(
        _feature_rows, "quality int, slots array<int>, counts array<int>"
    ).toArrow()
    good = rows.column("quality").to_numpy().astype(np.int64)
    lists = rows.column("slots").combine_chunks()
    text = np.repeat(np.arange(len(good)), lists.value_lengths().to_numpy())
    shares = np.array([sizes.get(0, 0), sizes.get(1, 0)], float)
    return fit(
        good,
        text,
        lists.flatten().to_numpy(),
        rows.column("counts").combine_chunks().flatten().to_numpy(),
        shares / max(shares.sum(), 1),
    )


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (with a text column) plus ``score``; narrow, every column is kept."""
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = shared_value(shared)
        for batch, words in chunks(batches):
            found = []
            for _, part, of_part in blocks(batch, words):
                found.append(own.score(own.latent(len(part), *features(part, of_part))))
            score = pa.array(np.clip(np.concatenate(found), 0, 1).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(run, docs.withColumn("score", F.lit(0.0)).schema)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out_fold: int = 2) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``; other columns are ignored) with held_out,
    score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= 0.7, else 0).

    Labels of rows whose crc32(doc_id as text) modulo ``folds`` is ``held_out_fold`` are never
    learned from.  A null or empty text, and any text without a similar labelled one, gets
    the share of label 1.  Rows with equal texts get equal scores.  Without labels all
    scores are 0.5.
    """
    held_out = lambda: F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_out_fold, F.lit(False)
    )
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    model = train(docs, labels.where(~held_out()))
    found = scores(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return found.select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )
