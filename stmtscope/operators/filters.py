"""Row filters of the load and of the reports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stmtscope.functions.timebounds import to_instant
from stmtscope.schema import EVENT_TYPES, RESET_CALL, RPC

# Longer value lists are joined instead of being put into the plan as literals.
MAX_INLINE_VALUES = 200
# The list lies on the driver; up to this size it is broadcast, a larger one is joined by shuffle.
MAX_BROADCAST_BYTES = 64 << 20


def keep_event_types(events: DataFrame, event_types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """Keep the statement-completed events (the list can be extended)."""
    return events.where(F.col("name").isin(*event_types))


def is_connection_reset(name: Column, object_name: Column) -> Column:
    """True for a pooled-connection reset call; a NULL object name is no reset."""
    return (name == RPC) & object_name.eqNullSafe(F.lit(RESET_CALL))


def drop_connection_resets(events: DataFrame, object_name: Column | None = None) -> DataFrame:
    """Drop ``sp_reset_connection`` calls; batches are never dropped."""
    if object_name is None:
        object_name = F.try_element_at(F.col("fields"), F.lit("object_name"))
    return events.where(~is_connection_reset(F.col("name"), object_name))


def in_time_range(
    start_time: str | datetime | None = None,
    end_time: str | datetime | None = None,
    tz_offset: str = "+00:00",
    day_first: bool | None = None,
) -> Column | None:
    """Whether an event lies inside the bounds, both inclusive; None without any bound.  The
    bounds become instants on the driver, so the comparison is with literals and reaches
    the file scan."""
    inside = None
    for bound, compare in ((start_time, "__ge__"), (end_time, "__le__")):
        if bound is not None:
            found = getattr(F.col("event_ts"), compare)(F.lit(to_instant(bound, tz_offset, day_first)))
            inside = found if inside is None else inside & found
    return inside


def within_time_range(
    events: DataFrame,
    start_time: str | datetime | None = None,
    end_time: str | datetime | None = None,
    tz_offset: str = "+00:00",
    day_first: bool | None = None,
    keep_missing: bool = False,
) -> DataFrame:
    """Keep events inside the bounds.  With ``keep_missing`` events without a time stay."""
    inside = in_time_range(start_time, end_time, tz_offset, day_first)
    if inside is None:
        inside = F.lit(True)
    return events.where(inside | F.col("event_ts").isNull() if keep_missing else inside)


def with_norm_texts(df: DataFrame, norm_texts: Iterable[str] | None) -> DataFrame:
    """Keep rows whose ``norm_text`` is in the list; ``None`` keeps everything."""
    if norm_texts is None:
        return df
    wanted = sorted(set(norm_texts))
    if len(wanted) <= MAX_INLINE_VALUES:
        return df.where(F.col("norm_text").isin(wanted))
    listed = df.sparkSession.createDataFrame([(t,) for t in wanted], "norm_text string")
    if sum(len(t.encode()) for t in wanted) <= MAX_BROADCAST_BYTES:
        listed = F.broadcast(listed)
    return df.join(listed, "norm_text", "left_semi")
