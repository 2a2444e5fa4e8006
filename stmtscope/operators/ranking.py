"""Exact ranks over groups too large for one task.

A plain window gives each group to one task, which a hot group breaks.  Here the
ordering value is first cut into ordered buckets by a fixed rule; only bucket
*counts* are ordered per group (their number is bounded by the rule), and the rows
themselves are ordered bucket by bucket.  A row's rank is its place in its bucket
plus the rows in the buckets before it, so nothing is approximated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stmtscope.operators.staging import checkpointed

# Buckets per doubling of the value: each spans about 0.017 % of it, and a group has
# at most 63 * 4096 of them per sign.
BUCKETS_PER_DOUBLING = 4096


def order_bucket(value: Column) -> Column:
    """Order-preserving bucket of a bigint; NULL for NULL."""
    size = F.floor(F.log2(F.abs(value.cast("double")) + 1) * BUCKETS_PER_DOUBLING)
    return F.when(value < 0, -size).otherwise(size).cast("int")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys``, NULL matching NULL; keeps the left key columns."""
    renamed = right.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = None
    for key in keys:
        same = F.col(key).eqNullSafe(F.col(f"_{key}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition).drop(*[f"_{key}" for key in keys])


def dense_ranks_desc(df: DataFrame, partition: str, value: str, name: str) -> DataFrame:
    """``DENSE_RANK() OVER (PARTITION BY partition ORDER BY value DESC)``, NULLs last, as one
    row per distinct value, to be joined back.

    The rank of a value is the number of larger distinct values plus one.
    """
    distinct = df.select(partition, value).distinct().withColumn("_bucket", order_bucket(F.col(value)))
    sizes = distinct.groupBy(partition, "_bucket").agg(F.count("*").alias("_size"))
    downwards = W.partitionBy(partition).orderBy(F.col("_bucket").desc_nulls_last())
    before = downwards.rowsBetween(W.unboundedPreceding, W.currentRow)
    offsets = sizes.select(
        partition, "_bucket", (F.sum("_size").over(before) - F.col("_size")).alias("_larger")
    )
    inside = W.partitionBy(partition, "_bucket").orderBy(F.col(value).desc_nulls_last())
    return join_null_safe(distinct, offsets, [partition, "_bucket"]).select(
        partition, value, (F.col("_larger") + F.row_number().over(inside)).cast("int").alias(name)
    )


def row_numbers(
    df: DataFrame,
    partition: str,
    value: str,
    tie_break: str,
    number: str,
    count: str,
    broadcast_offsets: int = 2_000_000,
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY partition ORDER BY value, tie_break)``, NULLs first,
    and the group's ``COUNT(*)``.

    The rows are dealt by range and ordered once, and stored so, with their place in their
    range.  Groups and equal values may be cut by ranges, so none is too large for a task;
    rows equal in all three columns may come in any order.  Per range and group one row of
    counts tells how many rows of the group lie before; those counts join the stored rows.
    The function runs a job.
    """
    order = [F.col(partition), F.col(value).asc_nulls_first(), F.col(tie_break)]
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = checkpointed(ordered.withColumn("_place", F.monotonically_increasing_id()))
    # The id's upper bits are the number of the range, in the order of the ranges.
    rows = placed.withColumn("_range", F.shiftright("_place", 33))
    parts = rows.groupBy("_range", partition).agg(F.min("_place").alias("_first"), F.count("*").alias("_size"))
    group = W.partitionBy(partition)
    before = group.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("_range").alias("_of_range"),
        F.col(partition).alias("_group"),
        "_first",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(group).alias(count),
    )
    offsets = checkpointed(offsets)
    if offsets.count() <= broadcast_offsets:
        offsets = F.broadcast(offsets)
    same = (F.col("_range") == F.col("_of_range")) & F.col(partition).eqNullSafe(F.col("_group"))
    return (
        rows.join(offsets, same)
        .withColumn(number, F.col("_place") - F.col("_first") + F.col("_before") + 1)
        .select(*df.columns, number, count)
    )
