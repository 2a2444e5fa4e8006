"""Near-duplicate documents by b-bit MinHash.

One pass over the texts gives each document its set of distinct word shingles, the minima
of ``BANDS * ROWS`` hash functions over that set, the lowest ``BITS`` bits of each minimum
packed into a signature, and one key per band of minima.  Documents with equal sets form a
class, which has a number and the text of its smallest doc_id; only classes are compared.

Classes that share a band key are candidates.  First each bucket's classes meet its smallest
one.  Buckets whose classes then lie in several components go on: each member outside a
bucket's largest component meets all members of other components, in blocks of both that
tasks compare as arrays.  A first pass takes up the likeliest pair of each class and
component only, which joins nearly all of a group; the second one takes up all that is
left, so no link between candidates is lost.

A candidate pair is first judged by the signatures: equal signature parts, corrected for the
2**-BITS that agree by chance, estimate the similarity.  A second sketch, the parity of the
set's members in each of ``PARITY_BITS`` cells, bounds the difference of the sets from below
and so rules out further pairs, never a true one.  What remains is confirmed on the full sets.

A pair of similarity 0.8 shares no band with probability (1 - 0.8**5)**32 = 3e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stmtscope.llm.components import smallest_reachable
from stmtscope.llm.scratch import Scratch
from stmtscope.llm.words import chunks, mix, words_of

BANDS, ROWS, BITS = 32, 5, 4
LONGS = BANDS * ROWS * BITS // 64
# The estimate of a pair at the threshold falls this far below with probability 1e-5 (4.2 deviations).
MARGIN = 0.14
PARITY_BITS = 1024
BLOCK_MEMBERS = 1024  # about; of one bucket, compared at once
BLOCK = 4096  # shingles hashed at once

_random = np.random.default_rng(7)
MULTIPLIERS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
BAND_SALTS = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
ROW_FACTORS = mix(np.arange(100, 100 + ROWS, dtype=np.uint64)) | np.uint64(1)

FEATURES = (
    "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, "
    "signature array<long>, parity array<long>, bands array<long>"
)


def shingle_hashes(words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in text order, and the first one of each text.  A text of
    fewer words has its whole sequence as its one shingle."""
    n_words = np.diff(words.first)
    n = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    first = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(first[-1]) - np.repeat(first[:-1] - words.first[:-1], n)
    short = np.repeat(np.where(n_words < shingle, n_words, shingle), n)
    total = np.zeros(len(at), np.uint64)
    for k in range(shingle):
        used = short > k
        total[used] = mix(total[used] + words.hash[at[used] + k] + np.uint64(k + 1))
    return total, first


def minima_of(shingles: np.ndarray) -> np.ndarray:
    least = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), BLOCK):
        hashed = MULTIPLIERS[:, None] * shingles[None, i : i + BLOCK]
        hashed += ADDENDS[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def signatures(minima: np.ndarray) -> np.ndarray:
    """Lowest bits of the minima, packed; one row per document."""
    per_long = 64 // BITS
    low = (minima & np.uint64((1 << BITS) - 1)).reshape(len(minima), LONGS, per_long)
    return np.bitwise_or.reduce(low << np.arange(0, 64, BITS, dtype=np.uint64), axis=2)


def band_keys(minima: np.ndarray) -> np.ndarray:
    parts = minima.reshape(len(minima), BANDS, ROWS) * ROW_FACTORS
    return mix(parts.sum(axis=2, dtype=np.uint64) + BAND_SALTS)


def parity(shingles: np.ndarray) -> np.ndarray:
    """Of each cell: whether it holds an odd number of the set's members."""
    odd = np.bincount((shingles >> np.uint64(17)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def most_different(size, percent: int):
    """Largest symmetric difference of a linked pair whose set sizes add up to ``size``."""
    return size * (100 - percent) / (100 + percent)


def _features(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in chunks(batches):
            shingles, first = shingle_hashes(words, shingle)
            n, minima, odd, set_a, set_b = [], [], [], [], []
            for a, b in zip(first[:-1], first[1:]):
                found = np.sort(shingles[a:b])
                if len(found) > 1:
                    found = found[np.concatenate([[True], found[1:] != found[:-1]])]
                n.append(len(found))
                minima.append(minima_of(found))
                odd.append(parity(found))
                set_a.append(mix(found).sum(dtype=np.uint64))
                set_b.append(mix(found ^ np.uint64(0x5BD1E9955BD1E995)).sum(dtype=np.uint64))
            least = np.array(minima).reshape(len(n), -1)
            lists = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.view(np.int64).ravel()), x.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(n, pa.int64()),
                    pa.array(np.array(set_a, np.uint64).view(np.int64)),
                    pa.array(np.array(set_b, np.uint64).view(np.int64)),
                    lists(signatures(least)).cast(pa.list_(pa.int64())),
                    lists(np.array(odd)).cast(pa.list_(pa.int64())),
                    lists(band_keys(least)).cast(pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "signature", "parity", "bands"],
            )

    return run


def _confirm(shingle: int, percent: int):
    """Pairs whose full sets have 100 * intersection >= percent * union."""

    def distinct(column: pa.Array) -> list[np.ndarray]:
        shingles, first = shingle_hashes(words_of(column), shingle)
        return [np.unique(shingles[a:b]) for a, b in zip(first[:-1], first[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), 256):
                batch = whole.slice(begin, 256)
                left_ids, texts = np.unique(batch.column("low").to_numpy(), return_index=True)
                left = dict(zip(left_ids.tolist(), distinct(batch.column("low_text").take(pa.array(texts)))))
                linked = []
                for low, own in zip(batch.column("low").to_pylist(), distinct(batch.column("high_text"))):
                    other = left[low]
                    if len(own) > len(other):
                        own, other = other, own
                    at = np.searchsorted(other, own)
                    at[at == len(other)] = 0
                    both = int((other[at] == own).sum()) if len(other) else 0
                    linked.append(100 * both >= percent * (len(own) + len(other) - both) and both > 0)
                keep = pa.array(linked, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("low").filter(keep), batch.column("high").filter(keep)], names=["low", "high"]
                )

    return run


def estimated_similarity(left, right):
    """From two signatures: share of equal parts, without those equal by chance."""
    equal = F.lit(BANDS * ROWS)
    each = sum(1 << i for i in range(0, 63, BITS))  # lowest bit of every part
    for i in range(LONGS):
        differ = left[i].bitwiseXOR(right[i])
        for k in range(BITS.bit_length() - 1):  # any set bit of a part reaches its lowest
            differ = differ.bitwiseOR(F.shiftrightunsigned(differ, 1 << k))
        equal = equal - F.bit_count(differ.bitwiseAND(F.lit(each)))
    chance = 2.0**-BITS
    return (equal / F.lit(float(BANDS * ROWS)) - chance) / (1 - chance)


def differing_cells(left, right):
    return sum((F.bit_count(left[i].bitwiseXOR(right[i])) for i in range(PARITY_BITS // 64)), F.lit(0))


class Members:
    """Some classes of one bucket, as arrays."""

    def __init__(self, rows: pa.Table):
        self.rep = rows.column("rep").to_numpy()
        self.component = rows.column("component").to_numpy()
        self.n = rows.column("n_shingles").to_numpy()
        self.signature, self.parity = (
            rows.column(c).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(self.rep), longs)
            for c, longs in (("signature", LONGS), ("parity", PARITY_BITS // 64))
        )


def likely_pairs(one: Members, other: Members, percent: int) -> list[tuple[np.ndarray, ...]]:
    """Pairs of different components that may be linked: places in both, and the estimate."""
    chance = 2.0**-BITS
    each = np.uint64(sum(1 << i for i in range(0, 63, BITS)))
    found = []
    for i in range(len(one.rep)):
        size = one.n[i] + other.n
        differ = np.bitwise_count(other.parity ^ one.parity[i]).sum(axis=1)
        at = np.flatnonzero((other.component != one.component[i]) & (differ <= most_different(size, percent)))
        if not len(at):
            continue
        parts = other.signature[at] ^ one.signature[i]
        for k in range(BITS.bit_length() - 1):  # any set bit of a part reaches its lowest
            parts |= parts >> np.uint64(1 << k)
        equal = 1 - np.bitwise_count(parts & each).sum(axis=1) / (BANDS * ROWS)
        estimate = (equal - chance) / (1 - chance)
        keep = (estimate >= percent / 100 - MARGIN) & (
            100 * np.minimum(one.n[i], other.n[at]) >= percent * np.maximum(one.n[i], other.n[at])
        )
        if keep.any():
            found.append((np.full(keep.sum(), i), at[keep], estimate[keep]))
    return found


def _compare(percent: int, best_only: bool):
    """Over rows ordered by block: likely pairs of each block's outsiders with its members."""

    def pairs_of(block: pa.Table) -> Iterator[pa.RecordBatch]:
        outside = block.column("outside").to_numpy(zero_copy_only=False)
        one, other = Members(block.filter(pa.array(outside))), Members(block.filter(pa.array(~outside)))
        found = likely_pairs(one, other, percent)
        if not found:
            return
        left, right, estimate = (np.concatenate(x) for x in zip(*found))
        if best_only:
            order = np.lexsort((-estimate, other.component[right], left))
            left, right, estimate = left[order], right[order], estimate[order]
            first = np.ones(len(left), bool)
            first[1:] = (left[1:] != left[:-1]) | (other.component[right[1:]] != other.component[right[:-1]])
            left, right, estimate = left[first], right[first], estimate[first]
        columns = [one.rep[left], other.rep[right], other.component[right], estimate]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["one", "other", "component", "estimate"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("key", "one_part", "other_part")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(batch)]):
                if held and tuple(keys[:, begin]) != last:
                    yield from pairs_of(pa.Table.from_batches(held))
                    held = []
                last = tuple(keys[:, begin])
                held.append(batch.slice(begin, end - begin))
        if held:
            yield from pairs_of(pa.Table.from_batches(held))

    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Links documents whose sets of distinct ``shingle``-word shingles have
    ``100 * intersection >= percent * union``.

    Per row of ``docs`` (``doc_id``, ``text``; other columns are ignored): doc_id,
    n_shingles (size of its set), component_id (smallest doc_id it reaches through links,
    itself included) and kept (it is that one).  A null or blank text has an empty set and
    is linked with nothing.  Rows with equal texts are linked, also if they share a doc_id; rows
    with one doc_id and different texts are documents of their own.
    A row without doc_id takes no part; its component_id is null and kept is false.
    """
    with Scratch(docs.sparkSession) as scratch:
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
        rows = scratch.keep(docs.mapInArrow(_features(shingle), FEATURES))
        classes = scratch.keep(
            rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
            .groupBy("set_a", "set_b")
            .agg(F.min(F.struct("doc_id", "text_hash", "n_shingles", "signature", "parity", "bands")).alias("x"))
            .select("set_a", "set_b", F.monotonically_increasing_id().alias("rep"), "x.*")
        )
        labels = _components(scratch, docs, classes, shingle, percent)
        placed = classes.select("rep", "doc_id").join(labels, "rep")
        least = placed.groupBy("component").agg(F.min("doc_id").alias("least"))
        named = (
            classes.select("set_a", "set_b", "rep", "doc_id")
            .join(placed.join(least, "component").select("rep", "least"), "rep", "left")
            .select("set_a", "set_b", F.coalesce("least", "doc_id").alias("component"))
        )
        result = (
            rows.select("doc_id", "n_shingles", "set_a", "set_b")
            .join(named, ["set_a", "set_b"], "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
            .select(
                "doc_id",
                "n_shingles",
                "component_id",
                F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
            )
        )
        return scratch.result(result)


def _components(scratch: Scratch, docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(rep, component) of all classes that share a band key with another one."""
    spots = classes.select("rep", F.explode("bands").alias("key"))
    shared = spots.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = scratch.keep(spots.join(shared, "key"))
    involved = members.select("rep").distinct()
    facts = scratch.keep(classes.join(involved, "rep", "left_semi").select("rep", "n_shingles", "signature", "parity"))
    # Texts of the classes that are compared at all, written once for all rounds.
    source = classes.join(involved, "rep", "left_semi").select("rep", "doc_id", "text_hash")
    texts = scratch.keep(docs.join(source, ["doc_id", "text_hash"]).select("rep", "text"))
    labels = facts.select("rep", F.col("rep").alias("component"))

    def merged(pairs: DataFrame) -> DataFrame:
        """New labels, after the pairs (one, other) were confirmed."""
        text = lambda name: texts.select(F.col("rep").alias(name), F.col("text").alias(f"{name}_text"))
        confirmed = (
            pairs.select(F.least("one", "other").alias("low"), F.greatest("one", "other").alias("high"))
            .distinct()
            .join(text("high"), "high")
            .join(text("low"), "low")
            .select("low", "low_text", "high", "high_text")
            .mapInArrow(_confirm(shingle, percent), "low long, high long")
        )
        of = lambda end: labels.select(F.col("rep").alias(end), F.col("component").alias(f"{end}_component"))
        links = scratch.keep(
            confirmed.join(of("low"), "low")
            .join(of("high"), "high")
            .select(
                F.least("low_component", "high_component").alias("low"),
                F.greatest("low_component", "high_component").alias("high"),
            )
            .where("low < high")
            .distinct()
        )
        roots = smallest_reachable(scratch, links)
        up = roots.select(F.col("node").alias("component"), F.col("component").alias("root"))
        return scratch.keep(
            labels.join(up, "component", "left").select("rep", F.coalesce("root", "component").alias("component"))
        )

    leaders = members.groupBy("key").agg(F.min("rep").alias("other"))
    side = lambda name: facts.select(F.col("rep").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in facts.columns[1:]])
    size = F.col("one_n_shingles") + F.col("other_n_shingles")
    stars = (
        members.join(leaders, "key")
        .where("rep > other")
        .select(F.col("rep").alias("one"), "other")
        .distinct()
        .join(side("one"), "one")
        .join(side("other"), "other")
        .where(differing_cells(F.col("one_parity"), F.col("other_parity")) <= most_different(size, percent))
        .where(estimated_similarity(F.col("one_signature"), F.col("other_signature")) >= percent / 100 - MARGIN)
    )
    labels = merged(stars)

    for best_only in (True, False):
        placed = members.join(labels, "rep").select("key", "rep", "component")
        parts = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
        several = (
            parts.groupBy("key")
            .agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("x"))
            .where("parts > 1")
            .select("key", "n", F.col("x.component").alias("largest"), (F.col("n") - F.col("x.n")).alias("n_outside"))
        )
        rows, n_open = scratch.keep_and_count(placed.join(several, "key"), F.lit(True))
        if not n_open:
            break
        members = rows.select("key", "rep")
        part = lambda n: F.pmod(F.xxhash64("rep"), n)
        one_parts, other_parts = F.ceil(F.col("n_outside") / BLOCK_MEMBERS), F.ceil(F.col("n") / BLOCK_MEMBERS)
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
        outside = rows.where("component <> largest").select(
            "key", "rep", "component", F.lit(True).alias("outside"), part(one_parts).alias("one_part"), every(other_parts).alias("other_part")
        )
        others = rows.select(
            "key", "rep", "component", F.lit(False).alias("outside"), every(one_parts).alias("one_part"), part(other_parts).alias("other_part")
        )
        block = ("key", "one_part", "other_part")
        pairs = (
            outside.unionByName(others)
            .join(facts, "rep")
            .repartition(*block)
            .sortWithinPartitions(*block)
            .mapInArrow(_compare(percent, best_only), "one long, other long, component long, estimate double")
        )
        if best_only:
            best = F.max(F.struct("estimate", "other")).alias("x")
            pairs = pairs.groupBy("one", "component").agg(best).select("one", F.col("x.other").alias("other"))
        labels = merged(pairs)
    return labels
