"""From raw documents to token ids, in five stages; each works on all that the one before kept.

    quality   documents that the classifier rejects go
    dedup     of each group of near copies one document stays
    private   personal data in the texts is replaced by its kind
    mix       sources are repeated towards even weights; every document comes at least once
    pieces    token ids

``run`` writes each stage as Parquet below the cluster's shared folder and reads it back for
the next one.  All stages but the last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stmtscope.llm import mixing, near_dup, pieces, pii, quality_vote
from stmtscope.llm.scratch import Scratch

HELD_OUT_FOLDS, HELD_OUT = 4, 2  # of the labels, as in the classifier's own query
ACCEPTED = 0.7
MAX_REPEATS = 2.0


def _with_rest(docs: DataFrame, *used: str) -> DataFrame:
    """``used`` columns, and all others in one called ``rest``, where no name can clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(*others).alias("rest")) if others else docs.select(*used, F.struct().alias("rest"))


def _restored(df: DataFrame, columns: list[str], *used: str) -> DataFrame:
    return df.select(*[F.col(c) if c in used else F.col("rest")[c].alias(c) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least ``ACCEPTED``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_FOLDS
    model = quality_vote.train(docs.select("doc_id", "text"), labels.where(fold != HELD_OUT).select("doc_id", "quality"))
    scored = quality_vote.scores(_with_rest(docs, "text"), model)
    return _restored(scored.where(F.col("score") >= ACCEPTED), docs.columns, "text")


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8.

    Rows are told apart by their place, so repeated rows are copies too and rows without
    doc_id are compared like all others; the first row of a group stays.
    """
    # ``docs`` is a stored table, so a row has the same place whenever it is read.
    placed = _with_rest(docs, "text").withColumn("doc_id", F.monotonically_increasing_id())
    found = near_dup.near_duplicates(placed.select("doc_id", "text"), shingle=5, percent=80)
    kept = found.where("kept").select("doc_id")
    return _restored(placed.join(kept, "doc_id", "left_semi"), docs.columns, "text")


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data; ``n_chars`` follows."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by temperature: the largest comes once, none over ``MAX_REPEATS`` times."""
    mixed = mixing.mix(_with_rest(docs, "doc_id", "source", "text"), budget=None, max_repeats=MAX_REPEATS)
    return _restored(mixed, docs.columns, "doc_id", "source", "text")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``token_ids`` of every row."""
    return pieces.encode(docs)


STAGES = [("quality", quality), ("dedup", dedup), ("private", private), ("mix", mix), ("pieces", encode)]

# The classifier, the links and the pieces are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for _, stage in STAGES[:-1]:
            docs = scratch.keep(stage(spark, docs, sf_dir))
        return scratch.result(STAGES[-1][1](spark, docs, sf_dir))
