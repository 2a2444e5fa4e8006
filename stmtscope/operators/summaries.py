"""Derived tables: exemplars, execution counts and per-metric statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stmtscope.operators.keyfilter import MAX_BROADCAST_LOG_WORDS, key_filter, log_words_for, might_be_in
from stmtscope.operators.ranking import (
    dense_ranks_desc,
    join_null_safe,
    order_bucket,
    row_numbers,
)
from stmtscope.operators.staging import checkpointed
from stmtscope.schema import (
    METRIC_SUMMARY,
    METRICS,
    PERCENTILES,
    UNIQUE_BATCHES,
    wide_metric_columns,
)

@dataclass(frozen=True)
class PlanLimits:
    """Sizes up to which the cheaper plan of two is taken.  Both plans give the same rows."""

    #: Rows of a fingerprint that one task orders; larger ones are folded into value buckets.
    group_rows: int = 1_000_000
    #: Fingerprint rows (a few numbers each) that are broadcast; more are joined by shuffle.
    broadcast_fingerprints: int = 2_000_000
    #: Binary logarithm of the words (16 bytes each) of a broadcast membership filter.
    filter_log_words: int = MAX_BROADCAST_LOG_WORDS
    #: Open percentile ranks (under 100 bytes each) that are broadcast.
    broadcast_ranks: int = 500_000
    #: Fingerprints that one task per metric ranks by total.
    window_fingerprints: int = 1_000_000


DEFAULT_LIMITS = PlanLimits()


def first_occurrences(batches: DataFrame) -> DataFrame:
    """First execution of each fingerprint: the smallest event sequence, of several with the
    same one the smallest text id."""
    first = F.min(F.struct("event_sequence", "text_id")).alias("first")
    return batches.groupBy("norm_id").agg(first).select("norm_id", "first.*")


def unique_batches(batches: DataFrame, limits: PlanLimits = DEFAULT_LIMITS) -> DataFrame:
    """One exemplar per fingerprint: its first execution, by event sequence, text id, event
    type and database.

    The first occurrences are found in a scan of three columns and checkpointed, so this
    function runs a job.  The texts are read in a second scan; see ``exemplar_rows``.
    """
    rows = exemplar_rows(batches, checkpointed(first_occurrences(batches)), limits)
    return rows.select(*UNIQUE_BATCHES.fieldNames())


# Bits of a filter per key below which it lets most rows pass: at 2, some 65 % of them.
LEAST_BITS_PER_KEY = 2
EXEMPLAR = ("event_type", "database_name", "orig_text", "norm_text")
OCCURRENCE = ("norm_id", "event_sequence", "text_id")


def exemplar_rows(batches: DataFrame, first: DataFrame, limits: PlanLimits = DEFAULT_LIMITS) -> DataFrame:
    """Exemplars with their event sequence and text id, given the stored first occurrences."""
    return first_rows(exemplar_candidates(batches, first, limits))


def exemplar_candidates(batches: DataFrame, first: DataFrame, limits: PlanLimits = DEFAULT_LIMITS) -> DataFrame:
    """Rows among which are the exemplars of all fingerprints, whose stored first occurrences are given.

    When these are few enough to broadcast, a semi-join finds the rows in place.  Otherwise a
    membership filter of them, of bounded size, is broadcast and cuts the rows in place, and
    only what passes is shuffled to meet the first occurrences.  The key of that join is nearly
    unique, so it has no hot values; no text is ever sorted or shuffled for rows that are cut.
    They may be too many for a filter of that size to cut anything.  Then all rows are candidates:
    ``first_rows`` orders them where they are, and a task passes on one per fingerprint.
    """
    n = first.count()
    rows = _exemplar_columns(batches)
    if n <= limits.broadcast_fingerprints:
        return rows.join(F.broadcast(first), list(OCCURRENCE), "left_semi")
    log_words = min(log_words_for(n), limits.filter_log_words)
    if LEAST_BITS_PER_KEY * n > 64 << log_words:
        return rows
    words = checkpointed(key_filter(first, OCCURRENCE, log_words))
    passed = might_be_in(rows, OCCURRENCE, F.broadcast(words), log_words)
    return passed.join(first, list(OCCURRENCE), "left_semi")


def _exemplar_columns(batches: DataFrame) -> DataFrame:
    return batches.select(
        "norm_id",
        "event_sequence",
        "text_id",
        "event_type",
        "database_name",
        F.col("text_data").alias("orig_text"),
        "norm_text",
    )


def exemplars_by_join(batches: DataFrame, first: DataFrame) -> DataFrame:
    """Exemplars as the fact rows that occur in ``first``."""
    kept = _exemplar_columns(batches).join(first, list(OCCURRENCE), "left_semi")
    return first_rows(kept).select(*UNIQUE_BATCHES.fieldNames())


def first_rows(rows: DataFrame) -> DataFrame:
    """The first row of each fingerprint, with its texts: each task passes on at most one per
    fingerprint.  Rows that share even the text id are told apart last."""
    row = F.min(F.struct("event_sequence", "text_id", *EXEMPLAR)).alias("row")
    return rows.groupBy("norm_id").agg(row).select("norm_id", "row.*")


def exemplars_by_aggregate(batches: DataFrame) -> DataFrame:
    """Exemplars in one aggregation."""
    return first_rows(_exemplar_columns(batches)).select(*UNIQUE_BATCHES.fieldNames())


def batch_summary(batches: DataFrame) -> DataFrame:
    """Executions, distinct raw texts and outcome counts per fingerprint."""
    return batches.groupBy("norm_id").agg(
        F.count("*").alias("all_executions"),
        F.count_distinct("text_id").alias("distinct_executions"),
        F.sum("successful").alias("successful_executions"),
        F.sum("failed").alias("failed_executions"),
        F.sum("aborted").alias("aborted_executions"),
    )


def numbered_executions(batches: DataFrame, metric: str) -> DataFrame:
    """Executions numbered by metric value within their fingerprint, with the number of
    executions; equal values are numbered by event sequence."""
    rows = batches.select("norm_id", "event_sequence", metric)
    return row_numbers(rows, "norm_id", metric, "event_sequence", "execution_number", "execution_count")


def metric_values(batches: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row per execution and metric; all metrics share one scan of just their columns."""
    return batches.select("norm_id", *metrics).unpivot("norm_id", list(metrics), "metric", "value")


def _numbered_values(batches: DataFrame, metrics: Sequence[str], of: Sequence[str]) -> DataFrame:
    """The same with each metric as its number in ``metrics``, for those in ``of``: a key of
    numbers alone is cheaper to aggregate, to sort and to shuffle."""
    numbered = [part for m in of for part in (F.lit(list(metrics).index(m)), F.col(m))]
    return batches.select("norm_id", F.stack(F.lit(len(of)), *numbered).alias("metric_no", "value"))


def _integer_mean(total: str, filled: str) -> Column:
    return F.expr(f"{total} div nullif({filled}, 0)").alias("mean")


def _min_if_few(p: str, executions: Column, otherwise: Column) -> Column:
    """A percentile of very few rows is their minimum."""
    few = 3 if p == "first_quartile" else 1
    return F.when(executions <= few, F.col("min")).otherwise(otherwise).alias(p)


def small_group_statistics(batches: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Statistics of fingerprints that fit a task, from one scan (see ``statistics_of_counts``)."""
    return statistics_of_counts(count_values(batches, metrics), metrics)


def counted_values(batches: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row per execution and metric, with the count 1, to be added up."""
    return _numbered_values(batches, metrics, metrics).withColumn("cnt", F.lit(1))


def count_values(batches: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """How often each value of each metric occurs per fingerprint; equal values are counted
    before the shuffle."""
    return counted_values(batches, metrics).groupBy("norm_id", "metric_no", "value").agg(F.sum("cnt").alias("cnt"))


def statistics_of_counts(counted: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Statistics from counted values: running sums of the counts give the value at each rank."""
    group = W.partitionBy("norm_id", "metric_no")
    before = group.orderBy(F.col("value").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    ordered = counted.withColumn("before", F.coalesce(F.sum("cnt").over(before), F.lit(0))).withColumn(
        "executions", F.sum("cnt").over(group)
    )
    # The value at a rank is the largest one with fewer rows before it than the rank.
    at_rank = {
        p: F.max(F.when(F.col("before") < F.expr(f"executions * {percent} div 100"), F.col("value")))
        for p, percent in PERCENTILES.items()
    }
    folded = ordered.groupBy("norm_id", "metric_no").agg(
        F.max("executions").alias("executions"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("cnt"))).alias("filled"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.sum(F.col("value") * F.col("cnt")).alias("total"),
        *[F.greatest(F.coalesce(value, F.lit(0)), F.lit(0)).alias(f"{p}_reached") for p, value in at_rank.items()],
    )
    names = F.array(*[F.lit(m) for m in metrics])
    executions = F.col("executions")
    return folded.select(
        "norm_id",
        F.get(names, "metric_no").alias("metric"),
        "min",
        _integer_mean("total", "filled"),
        "max",
        "total",
        *[_min_if_few(p, executions, F.col(f"{p}_reached")) for p in PERCENTILES],
    )


def _per_bucket(values: DataFrame) -> DataFrame:
    """Values folded into buckets, each with the rows before it in its group.  The fold
    happens mostly before the shuffle, and a group has a bounded number of buckets."""
    values = values.withColumn("bucket", order_bucket(F.col("value")))
    folded = values.groupBy("norm_id", "metric_no", "bucket").agg(
        F.sum("cnt").alias("size"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("cnt"))).alias("filled"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.sum(F.col("value") * F.col("cnt")).alias("bucket_total"),
    )
    # Both frames have one order, so they share a pass over the group.
    group = W.partitionBy("norm_id", "metric_no").orderBy(F.col("bucket").asc_nulls_first())
    upto = group.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = group.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    sums = {"before": F.sum("size").over(upto) - F.col("size"), "executions": F.sum("size").over(whole)}
    return folded.withColumns(sums)


def _per_group(buckets: DataFrame) -> DataFrame:
    """Group statistics and, for each percentile, the bucket that holds its rank: the last
    one with fewer rows before it than the rank.  Buckets are ordered, so ``max`` picks
    each attribute of that bucket."""
    aggregates = [
        F.max("executions").alias("executions"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
        F.sum("bucket_total").alias("total"),
        F.sum("filled").alias("filled"),
    ]
    for p, percent in PERCENTILES.items():
        reached = F.col("before") < F.expr(f"executions * {percent} div 100")
        for attribute in ("low", "high", "before"):
            aggregates.append(F.max(F.when(reached, F.col(attribute))).alias(f"{p}_{attribute}"))
    return buckets.groupBy("norm_id", "metric_no").agg(*aggregates)


def _is_open(p: str) -> Column:
    """The bucket of the percentile's rank holds different values, so it does not tell the
    percentile; where it only holds values up to 0 the percentile is 0."""
    low, high = F.col(f"{p}_low"), F.col(f"{p}_high")
    return F.coalesce((low < high) & (high > 0), F.lit(False))


def _open_ranks(groups: DataFrame) -> DataFrame:
    """One row per open percentile: its bucket, and the rank inside the bucket."""
    wanted = [
        F.when(
            _is_open(p),
            F.struct(
                F.lit(p).alias("percentile"),
                order_bucket(F.col(f"{p}_high")).alias("bucket"),
                (F.expr(f"executions * {percent} div 100") - F.col(f"{p}_before")).alias("rank"),
            ),
        )
        for p, percent in PERCENTILES.items()
    ]
    return groups.select("norm_id", "metric_no", F.inline(F.array_compact(F.array(*wanted))))


def _values_at_ranks(values: DataFrame, ranks: DataFrame, n_ranks: int, limits: PlanLimits) -> DataFrame:
    """The value at each open rank, one row per group with a ``{percentile}_exact`` column.

    Values outside the ranks' buckets are dropped before the shuffle: with few ranks by a
    broadcast of them, else by a broadcast membership filter of bounded size.  What passes is
    counted, which is spread over all tasks since the key includes the value, and then
    joined with the ranks.
    """
    key = ["norm_id", "metric_no", "bucket"]
    values = values.withColumn("bucket", order_bucket(F.col("value")))
    if n_ranks <= limits.broadcast_ranks:
        ranks = F.broadcast(ranks)
        values = values.join(ranks, key, "left_semi")
    else:
        log_words = min(log_words_for(n_ranks), limits.filter_log_words)
        words = checkpointed(key_filter(ranks, key, log_words))
        values = might_be_in(values, key, F.broadcast(words), log_words)
    counted = values.groupBy(*key, "value").agg(F.sum("cnt").alias("cnt"))
    upto = (
        W.partitionBy("norm_id", "metric_no", "percentile")
        .orderBy("value")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    hits = (
        counted.join(ranks, key)
        .repartition("norm_id", "metric_no")
        .withColumn("upto", F.sum("cnt").over(upto))
        .where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("cnt") < F.col("rank")))
    )
    return hits.groupBy("norm_id", "metric_no").agg(
        *[
            F.max(F.when(F.col("percentile") == p, F.col("value"))).alias(f"{p}_exact")
            for p in PERCENTILES
        ]
    )


def large_group_statistics(
    batches: DataFrame, metrics: Sequence[str], limits: PlanLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Statistics of fingerprints of any size, without giving a whole one to a task."""

    def values(of: Sequence[str]) -> DataFrame:
        return _numbered_values(batches, metrics, of).withColumn("cnt", F.lit(1))

    return _large_statistics(values, metrics, limits)


def _large_statistics(
    values_of: Callable[[Sequence[str]], DataFrame], metrics: Sequence[str], limits: PlanLimits
) -> DataFrame:
    """Statistics of large groups from (norm_id, metric_no, value, cnt) of the metrics asked for.

    Two scans.  The first counts value buckets and finds the bucket of every rank; its
    result, one row per fingerprint and metric, is checkpointed, so this function runs a
    job.  The second looks only at the buckets that hold a wanted rank and several values.

    A total has to fit a bigint, so a bucket of values around 2^e holds at most 2^(63-e)
    rows, and at most 2^(e-12.5) distinct values: fewer than 2^26 in any case, and far
    fewer for real measurements.
    """
    groups = checkpointed(_per_group(_per_bucket(values_of(metrics))))
    n_open = sum((_is_open(p).cast("long") for p in PERCENTILES), F.lit(0))
    # One row per metric.
    sizes = groups.groupBy("metric_no").agg(F.sum(n_open).alias("open")).collect()
    open_metrics = [metrics[i] for i in sorted(r.metric_no for r in sizes if r.open)]
    summary = groups
    if open_metrics:
        # A metric whose percentiles are all known is not read again.
        values = values_of(open_metrics)
        exact = _values_at_ranks(values, _open_ranks(groups), sum(r.open for r in sizes), limits)
        summary = groups.join(exact, ["norm_id", "metric_no"], "left")

    def found(p: str) -> Column:
        known = [F.col(f"{p}_exact")] if open_metrics else []
        return F.greatest(F.coalesce(*known, F.col(f"{p}_low"), F.lit(0)), F.lit(0))

    names = F.array(*[F.lit(m) for m in metrics])
    return summary.select(
        "norm_id",
        F.get(names, "metric_no").alias("metric"),
        "min",
        _integer_mean("total", "filled"),
        "max",
        "total",
        *[_min_if_few(p, F.col("executions"), found(p)) for p in PERCENTILES],
    )


def metric_summary(
    batches: DataFrame, metrics: Sequence[str] = METRICS, limits: PlanLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Per fingerprint and metric: minimum, integer mean, maximum, total, dense rank of the
    total within the metric, and six floor-rank percentiles.

    Percentile ``p`` of ``n`` rows is the value at rank ``floor(p * n)`` in ascending
    order, NULLs lowest, and never below 0.  The lowest quartile of up to three rows,
    and every other percentile of a single row, is the minimum.

    Executions are counted per fingerprint first, and the counts checkpointed, so this
    function runs a job.  Fingerprints with more rows than a task should order go by
    ``large_group_statistics``, the others by ``small_group_statistics``.
    """
    counts = checkpointed(batches.groupBy("norm_id").agg(F.count("*").alias("executions")))
    is_large = F.col("executions") > limits.group_rows
    fingerprints, n_large = counts.agg(F.count("*"), F.count_if(is_large)).first()
    if n_large == 0:
        statistics = small_group_statistics(batches, metrics)
    elif n_large == fingerprints or n_large > limits.broadcast_fingerprints:
        statistics = large_group_statistics(batches, metrics, limits)
    else:
        large = F.broadcast(counts.where(is_large).select("norm_id"))
        statistics = small_group_statistics(
            batches.join(large, "norm_id", "left_anti"), metrics
        ).union(large_group_statistics(batches.join(large, "norm_id", "left_semi"), metrics, limits))

    return _with_total_rank(statistics, fingerprints, limits)


def summary_of_states(
    profiles: DataFrame, counted: DataFrame, fingerprints: int, limits: PlanLimits = DEFAULT_LIMITS
) -> DataFrame:
    """``metric_summary`` of all metrics from the metrics of executions, for fingerprints that one task may
    order, and from counts of values (see ``count_values``) for the others."""
    # Dealt by fingerprint as whole executions: values are told apart, ordered and added up where they are.
    statistics = statistics_of_counts(counted_values(profiles.repartition("norm_id")), METRICS)
    if not counted.isEmpty():

        def values(of: Sequence[str]) -> DataFrame:
            return counted.where(F.col("metric_no").isin([METRICS.index(m) for m in of]))

        statistics = statistics.union(_large_statistics(values, METRICS, limits))
    return _with_total_rank(statistics, fingerprints, limits)


def _with_total_rank(statistics: DataFrame, fingerprints: int, limits: PlanLimits) -> DataFrame:
    if fingerprints <= limits.window_fingerprints:
        by_total = W.partitionBy("metric").orderBy(F.col("total").desc())
        ranked = statistics.withColumn("total_rank", F.dense_rank().over(by_total))
    else:
        statistics = checkpointed(statistics)
        ranks = dense_ranks_desc(statistics, "metric", "total", "total_rank")
        ranked = join_null_safe(statistics, ranks, ["metric", "total"])
    return ranked.select(*METRIC_SUMMARY.fieldNames())


def wide_metric_summary(summary: DataFrame, metric: str) -> DataFrame:
    """One metric of the long summary, under the column names of its own table."""
    names = wide_metric_columns(metric)
    return summary.where(F.col("metric") == metric).select(
        "norm_id", *[F.col(c).alias(n) for c, n in names.items()]
    )
