"""Loads: what one run adds to the fact table, written once and published at once.

Everything a load makes lies in a folder of its own: its rows (fact rows, rejects, and the file
names of filtered events), one line per file, and a membership filter of its keys.  No
reader sees the folder until the load is published, which is one step in the catalog: the folder's
fact rows become a partition of the fact table.  A load that fails, or is killed, leaves
the table as it was.  Loads of one table are expected to run one after the other.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stmtscope import schema
from stmtscope.operators.flatten import REASON, SELECTED, duplicate_keys
from stmtscope.operators.keyfilter import (
    MAX_BROADCAST_LOG_WORDS,
    counted_filter,
    found_in_filters,
    key_filter,
    log_words_for,
    might_be_in,
)
from stmtscope.operators.staging import COMPRESSION, checkpointed, delete_folder, make_folder, small_splits, subfolders

KEY = "event_sequence"
KIND, GOOD, REJECT, FILTERED = "kind", "fact", "reject", "filtered"
FILTER = "load_id string, log_words int, word long, bits long"
COUNTED_FILTER = FILTER + ", most long"
# Keys that passed a filter and are looked up as literals, which reach the file scan.
MAX_INLINE_KEYS = 1000
# Per row group a filter of the keys, of the size that its keys need.
WRITE_OPTIONS = {
    f"parquet.bloom.filter.enabled#{KEY}": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    **COMPRESSION,
}


class DuplicateKeyError(ValueError):
    """The fact table would hold an event sequence more than once."""


def new_id() -> str:
    """Ids in the order of time."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def database_folder(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


@dataclass(frozen=True)
class Load:
    """A load of one fact table, whose partitions are its published loads."""

    spark: SparkSession
    database: str
    suffix: str
    table: str
    load_id: str
    written: list[StructType] = field(default_factory=list)
    filters: list[int] = field(default_factory=list)

    @property
    def base(self) -> str:
        return f"{database_folder(self.spark, self.database)}/loads{self.suffix}"

    @property
    def folder(self) -> str:
        return f"{self.base}/{self.load_id}"

    @property
    def facts_folder(self) -> str:
        return f"{self.folder}/rows/{KIND}={GOOD}"

    def write_rows(self, flattened: DataFrame) -> None:
        """Write events flattened by ``flatten_all`` once, by kind; each task orders its facts by
        fingerprint, so that equal texts lie together and filters on one skip row groups."""
        delete_folder(self.spark, f"{self.folder}/rows")
        self.filters.clear()
        good = F.when(F.col(REASON).isNull(), GOOD).otherwise(REJECT)
        kind = F.when(F.col(SELECTED), good).otherwise(FILTERED)
        rows = flattened.withColumn(KIND, kind).sortWithinPartitions(KIND, "norm_id")
        with small_splits(self.spark):
            rows.write.options(**WRITE_OPTIONS).partitionBy(KIND).parquet(f"{self.folder}/rows")
        make_folder(self.spark, self.facts_folder)
        self.written.append(rows.schema)

    def rows(self) -> DataFrame:
        """What ``write_rows`` wrote."""
        return self.spark.read.schema(self.written[-1]).parquet(f"{self.folder}/rows")

    def write_facts(self, batches: DataFrame) -> None:
        """Write fact rows, by column name."""
        rows = batches.select(*schema.BATCHES.fieldNames()).sortWithinPartitions("norm_id")
        with small_splits(self.spark):
            rows.write.options(**WRITE_OPTIONS).parquet(self.facts_folder)

    def keys(self) -> DataFrame:
        return self.spark.read.schema(schema.BATCHES).parquet(self.facts_folder).select(KEY)

    def write_filter(self) -> None:
        """Write the filter of the load's keys, with the counts that show repeated ones; once for
        the rows that are written."""
        if self.filters:
            return
        keys = self.keys()
        log_words = log_words_for(keys.count())
        delete_folder(self.spark, f"{self.folder}/keys")
        words = counted_filter(keys, [KEY], log_words)
        words.select(
            F.lit(self.load_id).alias("load_id"), F.lit(log_words).alias("log_words"), "word", "bits", "most"
        ).sortWithinPartitions("word").write.parquet(f"{self.folder}/keys")
        self.filters.append(log_words)

    def repeated_keys(self) -> DataFrame:
        """Keys that the load holds more than once; they are only looked for where the counts say so."""
        self.write_filter()
        words = self.spark.read.schema(COUNTED_FILTER).parquet(f"{self.folder}/keys")
        if words.where("most > 1").isEmpty():
            return self.keys().where("false")
        return duplicate_keys(self.keys()).select(KEY)

    def publish(self) -> None:
        """Make the load's facts part of the table, after its filter of keys is written."""
        self.write_filter()
        self.spark.sql(f"ALTER TABLE {self.table} ADD PARTITION (load_id = '{self.load_id}') LOCATION '{self.facts_folder}'")
        self.spark.catalog.refreshTable(self.table)

    def discard(self) -> None:
        delete_folder(self.spark, self.folder)


def published_loads(spark: SparkSession, table: str) -> list[str]:
    """Ids of the loads that make up a fact table, oldest first."""
    return sorted(r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def unpublished_loads(load: Load) -> list[str]:
    """Folders that killed loads left behind; no reader sees them, and ``discard`` deletes them."""
    known = {*published_loads(load.spark, load.table), load.load_id}
    return sorted(name for name in subfolders(load.spark, load.base) if name not in known)


def _of_published(load: Load, name: str, columns) -> DataFrame:
    """The published loads' tables ``name``, as one."""
    folders = [f"{load.base}/{i}/{name}" for i in published_loads(load.spark, load.table)]
    if not folders:
        return load.spark.createDataFrame([], columns)
    return load.spark.read.schema(columns).option("ignoreMissingFiles", "true").parquet(*folders)


def loaded_files(load: Load) -> DataFrame:
    """The files of all published loads, one row per load and file."""
    return _of_published(load, "files", schema.LOADED_FILE)


def clashing_keys(load: Load) -> DataFrame:
    """Keys of the new load that published loads hold, with the load that has them.

    The new keys are looked up in the loads' filters.  Only of loads whose filter lets a key pass are
    keys read, and if the keys are few their values reach the scan, where row groups
    whose own filter or range excludes them are skipped.  If they are many, a filter of them is broadcast
    and cuts the old keys in place, so that few of these are shuffled.
    """
    stored = load.spark.table(load.table).select(KEY, "load_id")
    none = stored.where("false")
    if not published_loads(load.spark, load.table):
        return none
    filters = _of_published(load, "keys", FILTER)
    sizes = sorted(r.log_words for r in filters.select("log_words").distinct().collect())
    if not sizes:
        return none
    found = checkpointed(found_in_filters(load.keys(), [KEY], filters.withColumnRenamed("load_id", "of"), sizes))
    counts = found.groupBy("of").count().collect()  # at most one row per load
    if not counts:
        return none
    old = stored.where(F.col("load_id").isin([r.of for r in counts]))
    n_found = sum(r["count"] for r in counts)
    if n_found <= MAX_INLINE_KEYS:
        values = sorted({r[0] for r in found.select(KEY).collect()})
        return old.where(F.col(KEY).isin(values))
    log_words = min(log_words_for(n_found), MAX_BROADCAST_LOG_WORDS)
    near = might_be_in(old, [KEY], F.broadcast(key_filter(found, [KEY], log_words)), log_words)
    return near.join(found.select(KEY, F.col("of").alias("load_id")), [KEY, "load_id"], "left_semi")


def check_load(load: Load) -> None:
    """Raise when a key is repeated in the new load or already in a published one."""
    repeated = load.repeated_keys().limit(5).collect()
    sample = repeated or clashing_keys(load).select(KEY).limit(5).collect()
    if sample:
        shown = ", ".join(str(r[0]) for r in sample)
        raise DuplicateKeyError(f"duplicate {KEY}, for example {shown}")
