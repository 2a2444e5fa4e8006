"""Sink: the family of typed tables that a workload analysis keeps.

Every table is a view over a stored table.  The fact table's view shows all published loads.
Derived tables are stored in versions, and one small pointer table names the version of
each that the views show: when all tables of a new version are written, the pointer's place
is changed, which is one step in the catalog, and all views show the new version.  A failure
before it leaves the old version readable; the one before the current version is kept for
readers that have begun with it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stmtscope import schema
from stmtscope.operators.flatten import duplicate_keys
from stmtscope.operators.staging import COMPRESSION, make_folder
from stmtscope.sources.loads import DuplicateKeyError, Load, check_load, database_folder, new_id, published_loads

FACT = "batches"
TABLES = {
    FACT: schema.BATCHES,
    "unique_batches": schema.UNIQUE_BATCHES,
    "batch_summary": schema.BATCH_SUMMARY,
    **{f"{m}_summary": schema.wide_metric_summary(m) for m in schema.METRICS},
    "minute_report": schema.MINUTE_REPORT,
}
STATES = {
    "state_texts": schema.STATE_TEXTS,
    "state_values": schema.STATE_VALUES,
    "state_minutes": schema.STATE_MINUTES,
    "state_exemplars": schema.STATE_EXEMPLARS,
    "state_counts": schema.STATE_COUNTS,
    "state_profiles": schema.STATE_PROFILES,
}
VERSIONED = {base: columns for base, columns in (TABLES | STATES).items() if base != FACT}
# Order within the files: rows with much in common lie together.
ORDER = {"state_values": ("norm_id", "metric_no", "value")}
FAMILY = "base string, version string, loads array<string>, buckets int"


class Shown(NamedTuple):
    """What the view of a derived table shows."""

    version: str | None
    loads: list[str]
    buckets: int | None


def table_name(database: str, base: str, suffix: str = "") -> str:
    """``database.base+suffix``: loads with different suffixes sit side by side."""
    return f"{database}.{base}{suffix}"


def stored_name(database: str, base: str, suffix: str = "", buckets: int | None = None) -> str:
    """The stored table behind a view; one for each number of buckets."""
    return f"{table_name(database, base, suffix)}_parts{buckets or ''}"


def _family_name(database: str, suffix: str) -> str:
    return table_name(database, "family", suffix)


def create_tables(
    spark: SparkSession, database: str, suffix: str = "", location: str | None = None
) -> None:
    """Create the database, at ``location`` when given, and its empty typed tables.
    Existing ones stay as they are."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    if spark.catalog.tableExists(table_name(database, list(VERSIONED)[-1], suffix)):  # the last one made
        return
    family = _family_name(database, suffix)
    if not spark.catalog.tableExists(family):
        nowhere = f"{database_folder(spark, database)}/family{suffix}/none"
        make_folder(spark, nowhere)
        spark.sql(f"CREATE TABLE {family} ({FAMILY}) USING parquet LOCATION '{nowhere}'")
    facts = stored_name(database, FACT, suffix)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {facts} ({_columns(TABLES[FACT])}, load_id string) USING parquet PARTITIONED BY (load_id)")
    spark.sql(f"CREATE VIEW IF NOT EXISTS {table_name(database, FACT, suffix)} AS SELECT {_names(TABLES[FACT])} FROM {facts}")
    for base in VERSIONED:
        _create_stored(spark, database, base, suffix, None)
        _create_view(spark, database, base, suffix, None)


def _columns(columns) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)


def _names(columns) -> str:
    return ", ".join(f"`{f.name}`" for f in columns)


def _create_stored(spark: SparkSession, database: str, base: str, suffix: str, buckets: int | None) -> str:
    """The stored table of a derived one."""
    stored = stored_name(database, base, suffix, buckets)
    clustered = f"CLUSTERED BY (norm_id) SORTED BY (norm_id) INTO {buckets} BUCKETS" if buckets else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {stored} ({_columns(VERSIONED[base])}, version string) USING parquet "
        f"PARTITIONED BY (version) {clustered}"
    )
    return stored


def _create_view(spark: SparkSession, database: str, base: str, suffix: str, buckets: int | None) -> None:
    """The view on the current version of a stored table."""
    stored = stored_name(database, base, suffix, buckets)
    current = f"SELECT version FROM {_family_name(database, suffix)} WHERE base = '{base}'"
    spark.sql(
        f"CREATE OR REPLACE VIEW {table_name(database, base, suffix)} AS "
        f"SELECT {_names(VERSIONED[base])} FROM {stored} WHERE version = ({current})"
    )


def check_keys(batches: DataFrame, existing: DataFrame | None = None) -> None:
    """Raise when an event sequence is repeated in ``batches`` or already in ``existing``.

    For rows outside the table family; loads look their keys up in filters instead.  Old keys are
    only looked up: those in the new key range meet the new ones in a semi-join, so old keys
    are never counted, and Spark may broadcast the new side."""
    keys = batches.select("event_sequence")
    sample = duplicate_keys(keys).limit(5).collect()
    if not sample and existing is not None:
        low, high = keys.agg(F.min("event_sequence"), F.max("event_sequence")).first()
        if low is not None:
            old = existing.select("event_sequence").where(F.col("event_sequence").between(low, high))
            sample = old.join(keys, "event_sequence", "left_semi").limit(5).collect()
    if sample:
        shown = ", ".join(str(r.event_sequence) for r in sample)
        raise DuplicateKeyError(f"duplicate event_sequence, for example {shown}")


def new_load(spark: SparkSession, database: str, suffix: str = "") -> Load:
    """A load that is yet to be written, checked and published."""
    return Load(spark, database, suffix, stored_name(database, FACT, suffix), new_id())


def append_batches(batches: DataFrame, database: str, suffix: str = "", check: bool = True) -> None:
    """Append fact rows, by column name, as a load of their own: written once, checked, and
    published at once."""
    load = new_load(batches.sparkSession, database, suffix)
    try:
        load.write_facts(batches)
        if check:
            check_load(load)
        load.publish()
    except BaseException:
        load.discard()
        raise


def facts_of(spark: SparkSession, database: str, suffix: str, load_ids: Sequence[str]) -> DataFrame:
    """Fact rows of some loads; the files of others are not looked at."""
    rows = spark.table(stored_name(database, FACT, suffix))
    return rows.where(F.col("load_id").isin(*load_ids)).select(*TABLES[FACT].fieldNames())


def fact_loads(spark: SparkSession, database: str, suffix: str = "") -> list[str]:
    return published_loads(spark, stored_name(database, FACT, suffix))


def family(spark: SparkSession, database: str, suffix: str = "") -> dict[str, Shown]:
    """The version of each derived table that its view shows."""
    rows = spark.table(_family_name(database, suffix)).collect()  # a row per table
    return {r.base: Shown(r.version, list(r.loads or []), r.buckets) for r in rows}


@dataclass
class Version:
    """A new version of derived tables: ``store`` each, then ``show`` them all at once; tables
    not stored keep the version they show."""

    spark: SparkSession
    database: str
    suffix: str = ""
    buckets: int | None = None
    loads: Sequence[str] = ()
    version: str = field(default_factory=new_id)
    bases: dict[str, int | None] = field(default_factory=dict)

    def store(self, base: str, df: DataFrame) -> DataFrame:
        """Write one table, ordered by fingerprint within its files, and read it back."""
        spark = self.spark
        buckets = self.bases[base] = None if base in STATES else self.buckets
        stored = _create_stored(spark, self.database, base, self.suffix, buckets)
        rows = df.select(*VERSIONED[base].fieldNames())
        if buckets:
            dealt = rows.withColumn("version", F.lit(self.version)).repartition(buckets, "norm_id").write
            dealt = dealt.options(**COMPRESSION).bucketBy(buckets, "norm_id").sortBy("norm_id").partitionBy("version")
            dealt.format("parquet").mode("append").saveAsTable(stored)
        else:
            # No shuffle for the sake of the order: it would carry every row of every table once more.
            rows = rows.sortWithinPartitions(*ORDER.get(base, ("norm_id",)))
            folder = f"{database_folder(spark, self.database)}/{base}{self.suffix}_parts/version={self.version}"
            rows.write.options(**COMPRESSION).parquet(folder)
            spark.sql(f"ALTER TABLE {stored} ADD PARTITION (version = '{self.version}') LOCATION '{folder}'")
            spark.catalog.refreshTable(stored)
        return _of_version(spark, stored, base, self.version)

    def show(self) -> None:
        spark, database, suffix = self.spark, self.database, self.suffix
        before = family(spark, database, suffix)
        shown = before | {base: Shown(self.version, list(self.loads), buckets) for base, buckets in self.bases.items()}
        name = _family_name(database, suffix)
        folder = f"{database_folder(spark, database)}/family{suffix}/{self.version}"
        rows = [(base, s.version, s.loads, s.buckets) for base, s in shown.items()]
        spark.createDataFrame(rows, FAMILY).coalesce(1).write.parquet(folder)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
        for base, buckets in self.bases.items():
            old = before.get(base, Shown(None, [], None))
            if buckets != old.buckets:
                _create_view(spark, database, base, suffix, buckets)
            _drop_versions(spark, stored_name(database, base, suffix, buckets), {self.version, old.version})


def write_tables(
    derived: Mapping[str, DataFrame],
    database: str,
    suffix: str = "",
    buckets: int | None = None,
    loads: Sequence[str] = (),
) -> None:
    """Write a new version of derived tables and show all of them at once.

    With ``buckets`` they are bucketed by ``norm_id``: a table with one row per
    fingerprint has no hot bucket, and the report joins then need no shuffle.  The fact
    table is never bucketed, since one hot fingerprint would fill a single bucket.  A change of the
    number of buckets moves the views to other stored tables, one view after the other.
    """
    new = Version(next(iter(derived.values())).sparkSession, database, suffix, buckets, loads)
    for base, df in derived.items():
        new.store(base, df)
    new.show()


def stored_states(spark: SparkSession, database: str, suffix: str = "") -> tuple[dict[str, DataFrame], list[str]]:
    """The states behind the derived tables, and the loads they cover; nothing before the
    first summary."""
    shown = family(spark, database, suffix)
    if not all(base in shown for base in STATES):
        return {}, []
    states = {
        base: _of_version(spark, stored_name(database, base, suffix), base, shown[base].version) for base in STATES
    }
    return states, shown["state_counts"].loads


def _of_version(spark: SparkSession, stored: str, base: str, version: str) -> DataFrame:
    return spark.table(stored).where(F.col("version") == version).select(*VERSIONED[base].fieldNames())


def _drop_versions(spark: SparkSession, stored: str, kept: set[str | None]) -> None:
    for row in spark.sql(f"SHOW PARTITIONS {stored}").collect():
        version = row.partition.split("=", 1)[1]
        if version not in kept:
            spark.sql(f"ALTER TABLE {stored} DROP IF EXISTS PARTITION (version = '{version}')")
