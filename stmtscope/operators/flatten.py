"""Trace events -> flat fact rows: one narrow projection, no shuffle.

An event that lacks a required value, or holds one that cannot be cast, never fails
the load: it is set aside with a reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stmtscope.functions.comments import flat_comments
from stmtscope.functions.ids import norm_id, text_id
from stmtscope.functions.normalize import fingerprint_text, statement_text
from stmtscope.operators.filters import in_time_range, is_connection_reset
from stmtscope.schema import (
    BATCHES,
    EVENT_TYPES,
    METRICS,
    OUTCOMES,
    RPC,
)

REASON = "reject_reason"
# Of events read from text: what could not be read, and the line if it is no event at all.
READ_PROBLEM, RAW_LINE = "read_problem", "raw_line"
# Whether an event passed the load filters.
SELECTED = "selected"

ACTION_KEYS = (
    "event_sequence",
    "client_pid",
    "client_hostname",
    "client_app_name",
    "database_name",
    "username",
)
# Texts and the result may be NULL, but their keys have to be there.
NULLABLE_FIELDS = ("object_name", "statement", "batch_text", "result")
NUMBERS = {"event_sequence": "bigint", "client_pid": "int", **{m: "bigint" for m in METRICS}}


def outcome_flags(result: Column) -> dict[str, Column]:
    """``OK`` / ``Error`` / ``Abort`` -> one flag set; anything else -> none."""
    return {
        flag: F.coalesce((result == outcome).cast("int"), F.lit(0))
        for flag, outcome in OUTCOMES.items()
    }


def _computed_once(df: DataFrame, keep: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """``keep`` and the named values, each value computed exactly once per row.

    A plain projection is merged into the filters and projections above it, which repeats
    every expression at every use and makes the generated method too long for the JIT
    compiler.  A generated row is not merged.
    """
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return df.select(*keep, F.inline(F.array(row)))


def _raw_values(events: DataFrame, extra: Sequence[str]) -> DataFrame:
    """The dictionary values of an event as strings, ``raw_`` before the numbers; NULL means
    missing, except that a user name is optional."""
    values = {}
    for dictionary, keys in (("actions", ACTION_KEYS), ("fields", (*NULLABLE_FIELDS, *METRICS))):
        for key in keys:
            value = F.try_element_at(F.col(dictionary), F.lit(key))
            if key in NULLABLE_FIELDS:
                value = F.coalesce(value, F.when(F.map_contains_key(dictionary, key), F.lit("")))
            values[f"raw_{key}" if key in NUMBERS else key] = value
    return _computed_once(events, ["name", "event_ts", *extra], values)


def _first_problem(has_read_problem: bool) -> Column:
    """First reason, in column order, why an event cannot become a fact row."""
    is_rpc = F.col("name") == RPC
    checks = [F.col(READ_PROBLEM)] if has_read_problem else []
    checks.append(F.when(F.col("event_ts").isNull(), F.lit("missing event_ts")))

    def number(key: str, bad: Column) -> None:
        problem = F.when(F.col(f"raw_{key}").isNull(), F.lit(f"missing {key}"))
        checks.append(F.when(bad, problem.otherwise(F.lit(f"invalid {key}"))))

    def text(key: str, needed: Column = F.lit(True)) -> None:
        checks.append(F.when(needed & F.col(key).isNull(), F.lit(f"missing {key}")))

    number("event_sequence", F.col("event_sequence").isNull())
    number("client_pid", F.col("client_pid").isNull())
    for key in ("client_hostname", "client_app_name", "database_name", "result"):
        text(key)
    text("object_name", is_rpc)
    text("statement", is_rpc)
    text("batch_text", ~is_rpc)
    for key in METRICS:
        # The source counts are unsigned.
        number(key, F.col(key).isNull() | (F.col(key) < 0))
    return F.coalesce(*checks)


def flatten_events(
    events: DataFrame,
    capture_schema_name: bool = False,
    extra: Sequence[str] = (),
    reject_unbalanced: bool = False,
) -> DataFrame:
    """The 21 fact columns plus ``reject_reason`` (NULL for a good row) and any ``extra``
    input columns."""
    raw = _raw_values(events, extra)
    numbers = {key: F.col(f"raw_{key}").try_cast(kind) for key, kind in NUMBERS.items()}
    parsed = _computed_once(raw, raw.columns, numbers)
    generated = {
        "event_type": F.col("name"),
        "event_ts": F.col("event_ts").cast("timestamp"),
        "text_data": statement_text(F.col("name"), F.col("statement"), F.col("batch_text")),
        **outcome_flags(F.col("result")),
    }
    late = ("text_id", "norm_id", "norm_text")
    typed = parsed.select(
        *[generated.get(c, F.col(c)).alias(c) for c in BATCHES.fieldNames() if c not in late],
        "object_name",
        _first_problem(READ_PROBLEM in extra).alias(REASON),
        *extra,
    )
    fingerprint = fingerprint_text(
        F.col("event_type"), F.col("object_name"), F.col("text_data"), capture_schema_name, reject_unbalanced, F.col("_flat")
    )
    named = typed.withColumn("_flat", flat_comments(F.col("text_data"))).withColumn("norm_text", fingerprint)
    ids = {
        "text_id": text_id(F.col("text_data")),
        "norm_id": norm_id(F.col("database_name"), F.col("norm_text")),
    }
    return named.select(
        *[ids.get(c, F.col(c)).alias(c) for c in BATCHES.fieldNames()], REASON, *extra
    )


def is_selected(
    events: DataFrame,
    event_types: Sequence[str] = EVENT_TYPES,
    start_time: str | datetime | None = None,
    end_time: str | datetime | None = None,
    tz_offset: str = "+00:00",
    filter_connection_resets: bool = False,
    day_first: bool | None = None,
) -> Column:
    """Whether an event passes the load filters.  One without a time, or a line that is no
    event, does, to be rejected by name; without a bound there is no filter on time."""
    chosen = F.col("name").isin(*event_types)
    if filter_connection_resets:
        chosen &= ~is_connection_reset(F.col("name"), F.try_element_at(F.col("fields"), F.lit("object_name")))
    inside = in_time_range(start_time, end_time, tz_offset, day_first)
    if inside is not None:
        chosen &= inside | F.col("event_ts").isNull()
    if RAW_LINE in events.columns:
        chosen |= F.col(RAW_LINE).isNotNull()
    return F.coalesce(chosen, F.lit(False))


def select_events(events: DataFrame, **filters) -> DataFrame:
    """Apply the load filters (see ``is_selected``)."""
    return events.where(is_selected(events, **filters))


def flatten_all(
    events: DataFrame, capture_schema_name: bool = False, reject_unbalanced: bool = False, **filters
) -> DataFrame:
    """All events flattened in one pass, with ``selected``; of those filtered out only the
    file name is kept."""
    marked = events.withColumn(SELECTED, is_selected(events, **filters))
    slim = marked.select(*[c if c in ("file_name", SELECTED) else F.when(F.col(SELECTED), F.col(c)).alias(c) for c in marked.columns])
    return flatten_events(slim, capture_schema_name, [*_extra_of(events), SELECTED], reject_unbalanced)


def _extra_of(events: DataFrame) -> list[str]:
    return [c for c in ("file_name", READ_PROBLEM, RAW_LINE) if c in events.columns]


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flattened events as ``(good, rejects)``.  ``good`` has the fact columns; ``rejects``
    has the event's sequence, type and time, its file and unreadable line when known, and
    the reason."""
    if SELECTED in rows.columns:
        rows = rows.where(SELECTED)
    known = [c for c in ("file_name", RAW_LINE) if c in rows.columns]
    good = rows.where(F.col(REASON).isNull()).select(*BATCHES.fieldNames())
    rejects = rows.where(F.col(REASON).isNotNull()).select(
        "event_sequence", "event_type", "event_ts", *known, REASON
    )
    return good, rejects


def to_batches(
    events: DataFrame, capture_schema_name: bool = False, reject_unbalanced: bool = False, **filters
) -> tuple[DataFrame, DataFrame]:
    """Filter and flatten events, split into ``(good, rejects)``."""
    rows = flatten_events(select_events(events, **filters), capture_schema_name, _extra_of(events), reject_unbalanced)
    return split_rejects(rows)


def duplicate_keys(batches: DataFrame, key: str = "event_sequence") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    counts = batches.groupBy(key).agg(F.count("*").alias("occurrences"))
    return counts.where(F.col("occurrences") > 1)
