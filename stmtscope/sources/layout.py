"""Layout of stored facts: a space-filling order of fingerprint and time.

A load's facts are ordered by fingerprint inside each task, which costs no shuffle, but a filter
on an hour then reads every file.  ``cluster_facts`` deals the facts of published loads anew, in the
order of their place on a curve through (fingerprint, time).  A file, and a row group in it, then
spans a small range of both, and a filter on either reads about the square root of all row groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stmtscope.operators.staging import delete_folder, small_splits
from stmtscope.schema import BATCHES
from stmtscope.sources.loads import WRITE_OPTIONS, Load, new_id
from stmtscope.sources.tables import fact_loads, facts_of, new_load

BITS = 16  # of each coordinate
ID_BITS = 60  # of a fingerprint, which is a hash and so spread evenly
# Of a task's rows in memory, where they are ordered: the texts, and about as much for all else as below.
TASK_BYTES = 256 << 20
ROW_BYTES = 280


def _interleaved(x: Column, y: Column) -> Column:
    """Bits of x and y in turns, those of x above: the place on the curve."""
    place = None
    for i in range(BITS):
        for shift, value in ((2 * i + 1, x), (2 * i, y)):
            bit = F.shiftleft(F.shiftright(value, i).bitwiseAND(F.lit(1)), shift)
            place = bit if place is None else place.bitwiseOR(bit)
    return place


def curve_place(first: int, last: int) -> Column:
    """Place of a fact whose time lies between two seconds since 1970."""
    by_id = F.shiftright("norm_id", ID_BITS - BITS).bitwiseAND(F.lit((1 << BITS) - 1))
    seconds = F.unix_timestamp("event_ts") - first
    by_time = F.floor(seconds * ((1 << BITS) - 1) / max(1, last - first)).cast("long")
    return _interleaved(by_id, by_time)


def clustered(facts: DataFrame, files: int) -> DataFrame:
    """Facts dealt to ``files`` tasks in the order of the curve, or to more where the rows of so few
    would not be ordered in memory.  The range of times and the size are found by a
    job of their own; a hot fingerprint is cut by time, so no range of the curve is too large."""
    seconds = F.unix_timestamp("event_ts")
    texts = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in ("text_data", "norm_text")]
    size = F.sum(texts[0] + texts[1] + ROW_BYTES)
    first, last, n_bytes = facts.agg(F.min(seconds), F.max(seconds), size).first()
    order = [curve_place(first or 0, last or 0), F.col("norm_id"), F.col("event_ts")]
    tasks = max(files, -(-(n_bytes or 0) // TASK_BYTES))
    return facts.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def cluster_facts(
    spark: SparkSession,
    database: str,
    suffix: str = "",
    load_ids: Sequence[str] | None = None,
    files: int = 200,
    write_options: dict[str, str] | None = None,
) -> None:
    """Rewrite the facts of published loads (all, unless some are named) in the order of the curve.

    Each load stays a load: its new files are written beside the old ones, its partition is pointed
    to them in one step, and then the old ones are deleted, so readers that began before should
    have ended.  This shuffles the facts once and is meant for loads that are read often.
    """
    table = new_load(spark, database, suffix).table
    for load_id in fact_loads(spark, database, suffix) if load_ids is None else load_ids:
        load = Load(spark, database, suffix, table, load_id)
        facts = facts_of(spark, database, suffix, [load_id])
        old = {f.rsplit("/", 1)[0] for f in facts.inputFiles()}
        folder = f"{load.folder}/clustered-{new_id()}"
        with small_splits(spark):
            rows = clustered(facts.select(*BATCHES.fieldNames()), files)
            rows.write.options(**WRITE_OPTIONS, **(write_options or {})).parquet(folder)
        spark.sql(f"ALTER TABLE {table} PARTITION (load_id = '{load_id}') SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
        for place in old:
            delete_folder(spark, place)
