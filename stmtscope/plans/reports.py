"""Reports over the fact table and the derived tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stmtscope.operators.filters import with_norm_texts
from stmtscope.operators.states import MINUTE_KEY, added_up
from stmtscope.schema import (
    DEFAULT_VCORES,
    MINUTE_REPORT,
    PERCENTILES,
    STATE_MINUTES,
    TOTAL_UNITS,
    wide_metric_columns,
)


def minute_report(batches: DataFrame, vcores: int = DEFAULT_VCORES) -> DataFrame:
    """Load per minute, database and fingerprint.  ``cpu_pct`` is the share of the minute's
    capacity on ``vcores`` cores, rounded once from the exact quotient.  It is no share of the time that
    passed: executions count in the minute of their event, so it may be of any size."""
    return minute_report_of(minute_sums(batches), vcores)


def minute_rows(batches: DataFrame) -> DataFrame:
    """Executions as sums per minute, database and fingerprint of one execution each, which add up
    with those of other loads."""
    return batches.select(
        F.date_trunc("minute", "event_ts").alias("minute"),
        "database_name",
        "norm_id",
        F.lit(1).cast("long").alias("execution_count"),
        F.col("duration").alias("duration_us"),
        F.col("cpu_time").alias("cpu_us"),
        F.col("logical_reads").alias("logical_reads_pages"),
        F.col("physical_reads").alias("physical_reads_pages"),
        F.col("writes").alias("writes_pages"),
        F.col("row_count").alias("row_total"),
        F.col("row_count").isNotNull().cast("long").alias("row_filled"),
    )


def minute_sums(batches: DataFrame) -> DataFrame:
    """Sums per minute, database and fingerprint."""
    return added_up(minute_rows(batches), STATE_MINUTES, MINUTE_KEY)


def minute_report_of(rollup: DataFrame, vcores: int = DEFAULT_VCORES) -> DataFrame:
    """The minute report from its sums."""
    share = F.expr(f"cast(cpu_us as decimal(20,0)) * 100 / cast({60_000_000 * vcores} as bigint)")
    return (
        rollup.withColumn("cpu_pct", share.cast(MINUTE_REPORT["cpu_pct"].dataType))
        .withColumn("avg_row_count", F.expr("row_total div nullif(row_filled, 0)"))
        .select(*MINUTE_REPORT.fieldNames())
    )


def minute_series(
    minutes: DataFrame, unique: DataFrame, norm_texts: Iterable[str] | None = None
) -> DataFrame:
    """Minute report with statement texts, in time order."""
    texts = with_norm_texts(unique, norm_texts).select("norm_id", "norm_text")
    return (
        minutes.join(texts, "norm_id")
        .select(
            "minute", "norm_id", "database_name", "norm_text", "execution_count",
            "duration_us", "cpu_us", "cpu_pct", "logical_reads_pages",
            "physical_reads_pages", "writes_pages", "avg_row_count",
        )
        .orderBy("minute", "norm_id")
    )


def metric_report(
    metric: str,
    summary: DataFrame,
    counts: DataFrame,
    unique: DataFrame,
    norm_texts: Iterable[str] | None = None,
    top_k: int | None = None,
) -> DataFrame:
    """Statements ranked by the reported total of one metric, largest first.

    ``summary`` is the metric's own table (``wide_metric_summary``); ``top_k`` keeps the
    statements whose total rank is at most k, ties included.
    """
    names = wide_metric_columns(metric)
    suffix, divisor = TOTAL_UNITS[metric]
    total = f"total_{metric}{suffix}"
    if top_k is not None:
        summary = summary.where(F.col(names["total_rank"]) <= top_k)
    texts = with_norm_texts(unique, norm_texts).select("norm_id", "database_name", "norm_text")
    return (
        summary.join(counts.select("norm_id", "all_executions"), "norm_id")
        .join(texts, "norm_id")
        .select(
            "norm_id",
            "database_name",
            "norm_text",
            "all_executions",
            names["min"],
            names["mean"],
            names["max"],
            F.expr(f"{names['total']} div {divisor}").alias(total),
            *[names[p] for p in PERCENTILES],
        )
        .orderBy(F.col(total).desc(), "norm_id")
    )
