"""Aggregate states of the derived tables, so that a further load is added without reading the
loads before it.

A state holds, per fingerprint, its counts, its texts, the values of each metric, sums per minute, and
the exemplar.  All of them merge: new rows are put beside the stored ones, and both are added up
together, so each travels once.  Every derived table follows exactly, also distinct counts and percentiles.

Values are kept in one of two forms.  A fingerprint that one task may order has the metrics of its
executions, a row for each (profiles): that is less than a row for each metric and value, and is dealt by
fingerprint without being counted.  A larger one has the counts of its values, and keeps this form.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stmtscope.operators.staging import checkpointed
from stmtscope.operators.summaries import (
    DEFAULT_LIMITS,
    PlanLimits,
    counted_values,
    exemplar_candidates,
    first_rows,
    summary_of_states,
    wide_metric_summary,
)
from stmtscope.schema import (
    METRICS,
    STATE_COUNTS,
    STATE_EXEMPLARS,
    STATE_MINUTES,
    STATE_PROFILES,
    STATE_TEXTS,
    STATE_VALUES,
    UNIQUE_BATCHES,
)

VALUE_KEY = ("norm_id", "metric_no", "value")
MINUTE_KEY = ("minute", "database_name", "norm_id")


def added_up(rows: DataFrame, schema: StructType, key: Sequence[str]) -> DataFrame:
    """Columns besides the key added up."""
    return rows.groupBy(*key).agg(*[F.sum(c).alias(c) for c in schema.fieldNames() if c not in key])


def _by_size(
    old: Mapping[str, DataFrame], counts: DataFrame, limits: PlanLimits
) -> tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]:
    """Two functions that cut rows to the fingerprints that one task may order, and to the larger ones.
    What is stored as counts of values stays so."""
    large = counts.where(F.col("executions") > limits.group_rows).select("norm_id")
    if old:
        large = large.union(old["state_values"].select("norm_id")).distinct()
    large = checkpointed(large)
    n = large.count()

    def every(rows: DataFrame) -> DataFrame:
        return rows

    def none(rows: DataFrame) -> DataFrame:
        return rows.where("false")

    if n == 0:
        return every, none
    if n > limits.broadcast_fingerprints:
        return none, every
    return (
        lambda rows: rows.join(F.broadcast(large), "norm_id", "left_anti"),
        lambda rows: rows.join(F.broadcast(large), "norm_id", "left_semi"),
    )


def added_states(
    old: Mapping[str, DataFrame],
    batches: DataFrame,
    minute_rows: Callable[[DataFrame], DataFrame],
    limits: PlanLimits = DEFAULT_LIMITS,
) -> dict[str, DataFrame]:
    """Stored states, if there are any, and fact rows together; ``minute_rows`` gives the rows that add up to
    sums per minute.  Runs a job: it has to be known how large fingerprints are and which rows come first."""

    def both(base: str, schema: StructType, new: DataFrame) -> DataFrame:
        columns = schema.fieldNames()
        return old[base].select(*columns).unionByName(new.select(*columns)) if old else new.select(*columns)

    found = checkpointed(
        batches.groupBy("norm_id").agg(
            F.count("*").alias("executions"),
            F.sum("successful").alias("successful"),
            F.sum("failed").alias("failed"),
            F.sum("aborted").alias("aborted"),
            F.min(F.struct("event_sequence", "text_id")).alias("first"),
        )
    )
    counts = both("state_counts", STATE_COUNTS, found)
    if old:
        counts = checkpointed(added_up(counts, STATE_COUNTS, ["norm_id"]))
    small, large = _by_size(old, counts, limits)
    profiles = both("state_profiles", STATE_PROFILES, batches)
    values = counted_values(large(profiles))
    candidates = exemplar_candidates(batches, found.select("norm_id", "first.*"), limits)
    return {
        "state_counts": counts,
        "state_texts": both("state_texts", STATE_TEXTS, batches).distinct(),
        "state_profiles": small(profiles),
        "state_values": added_up(both("state_values", STATE_VALUES, values), STATE_VALUES, VALUE_KEY),
        "state_minutes": added_up(both("state_minutes", STATE_MINUTES, minute_rows(batches)), STATE_MINUTES, MINUTE_KEY),
        "state_exemplars": first_rows(both("state_exemplars", STATE_EXEMPLARS, candidates)),
    }


def derived_tables(
    states: Mapping[str, DataFrame], minute_report: Callable[[DataFrame], DataFrame], limits: PlanLimits = DEFAULT_LIMITS
) -> dict[str, DataFrame]:
    """The derived tables that the states stand for."""
    counts = states["state_counts"]
    texts = states["state_texts"].groupBy("norm_id").agg(F.count("*").alias("distinct_executions"))
    together = counts.unionByName(texts, allowMissingColumns=True).groupBy("norm_id").agg(
        F.sum("executions").alias("all_executions"),
        F.sum("distinct_executions").alias("distinct_executions"),
        F.sum("successful").alias("successful_executions"),
        F.sum("failed").alias("failed_executions"),
        F.sum("aborted").alias("aborted_executions"),
    )
    # Six tables come from one summary; it has a row per fingerprint and metric.
    summary = checkpointed(summary_of_states(states["state_profiles"], states["state_values"], counts.count(), limits))
    return {
        "unique_batches": states["state_exemplars"].select(*UNIQUE_BATCHES.fieldNames()),
        "batch_summary": together,
        **{f"{m}_summary": wide_metric_summary(summary, m) for m in METRICS},
        "minute_report": minute_report(states["state_minutes"]),
    }
