"""The two jobs of a workload analysis: load the events, then derive the tables."""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stmtscope.operators.flatten import REASON, flatten_all, split_rejects
from stmtscope.operators.staging import checkpointed, small_splits
from stmtscope.operators.states import added_states, derived_tables
from stmtscope.operators.summaries import DEFAULT_LIMITS, PlanLimits
from stmtscope.plans.reports import metric_report, minute_report_of, minute_rows, minute_series
from stmtscope.schema import DEFAULT_VCORES, EVENT, EVENT_TYPES, LOADED_FILE
from stmtscope.sources.events import as_plain_path, damaged_files, listed_files, load_stats, read_events
from stmtscope.sources.loads import Load, check_load, loaded_files
from stmtscope.sources.tables import Version, create_tables, fact_loads, facts_of, new_load, stored_states, table_name

UNREADABLE = "unreadable file"


@dataclass
class LoadOptions:
    """What to load and where to put it."""

    path: str
    suffix: str
    database: str = "stmtscope"
    location: str | None = None
    pattern: str = "*"
    fmt: str = "json"
    event_types: tuple[str, ...] = EVENT_TYPES
    start_time: str | datetime | None = None
    end_time: str | datetime | None = None
    tz_offset: str = "+00:00"
    day_first: bool | None = None
    filter_connection_resets: bool = False
    capture_schema_name: bool = False
    reject_unbalanced: bool = False
    vcores: int = DEFAULT_VCORES
    buckets: int | None = None
    only_new_files: bool = False
    skip_damaged_files: bool = False
    reader_options: dict[str, str] = field(default_factory=dict)

    def filters(self) -> dict:
        return {
            "event_types": self.event_types,
            "start_time": self.start_time,
            "end_time": self.end_time,
            "tz_offset": self.tz_offset,
            "day_first": self.day_first,
            "filter_connection_resets": self.filter_connection_resets,
        }


def load(spark: SparkSession, options: LoadOptions) -> tuple[DataFrame, DataFrame]:
    """Append the folder's events to the fact table; gives ``(stats, rejects)``.

    Events are read, parsed and normalised once and written once, into the folder of this load.
    The counts, the key check and the filter of keys come from there.  The load is then
    published in one step; when it fails before, its folder is deleted and the table is as it was.

    With ``only_new_files`` files of published loads (same name, size and time) are left out, so a
    folder that grows can be loaded again and again, each file exactly once.  With
    ``skip_damaged_files`` files that cannot be read become rejects, and are tried again by the next
    load; without, one such file fails the load.
    """
    create_tables(spark, options.database, options.suffix, options.location)
    new = new_load(spark, options.database, options.suffix)
    try:
        files = checkpointed(listed_files(spark, options.path, options.pattern))
        paths: str | list[str] = options.path
        if options.only_new_files:
            seen = loaded_files(new).where("problem IS NULL").select("file_name", "bytes", "modified")
            files = checkpointed(files.join(seen, ["file_name", "bytes", "modified"], "left_anti"))
            paths = _paths(files)
        problems = _write_rows(new, options, files, paths)
        rows = new.rows()
        counts = load_stats(rows, files.select("file_name"))
        found = spark.createDataFrame(list(problems.items()), "path string, problem string")
        about = files.join(F.broadcast(found), "path", "left").join(counts, "file_name")
        about.withColumn("load_id", F.lit(new.load_id)).select(*LOADED_FILE.fieldNames()).write.parquet(f"{new.folder}/files")
        check_load(new)
        new.publish()
    except BaseException:
        new.discard()
        raise
    about = spark.read.schema(LOADED_FILE).parquet(f"{new.folder}/files")
    stats = about.select("file_name", *[c for c in about.columns if c.startswith("events_")])
    _, rejects = split_rejects(rows)
    if problems:
        unread = about.where("problem IS NOT NULL").select("file_name", F.lit(UNREADABLE).alias(REASON))
        rejects = rejects.unionByName(unread, allowMissingColumns=True)
    return stats, rejects


def _paths(files: DataFrame) -> list[str]:
    """Paths of files to read; the driver keeps such a list of any folder it reads."""
    return [as_plain_path(r.path) for r in files.where("path IS NOT NULL").select("path").collect()]


def _write_rows(new: Load, options: LoadOptions, files: DataFrame, paths: str | list[str]) -> dict[str, str]:
    """Write the load's rows; gives the files that could not be read, with the reason.  Only
    after a failure are files looked at one by one."""

    def events(some: str | list[str]) -> DataFrame:
        if not some:
            return new.spark.createDataFrame([], EVENT).withColumn("file_name", F.lit("")).where("false")
        return read_events(new.spark, some, options.pattern, options.fmt, **options.reader_options)

    def write(some: str | list[str]) -> None:
        new.write_rows(flatten_all(events(some), options.capture_schema_name, options.reject_unbalanced, **options.filters()))

    try:
        write(paths)
        return {}
    except Exception:
        if not options.skip_damaged_files:
            raise
        every = {as_plain_path(r.path): r.path for r in files.where("path IS NOT NULL").select("path").collect()}
        damaged = damaged_files(new.spark, sorted(every), events)
        if not damaged:
            raise
        write([p for p in every if p not in damaged])
        return {every[p]: reason for p, reason in damaged.items()}


def summarize(spark: SparkSession, options: LoadOptions, limits: PlanLimits = DEFAULT_LIMITS) -> None:
    """Bring every derived table up to the published loads.

    Only facts of loads that the tables do not cover yet are read; they are added to the stored
    states, and all tables follow from these.  The new tables and states are shown at once.
    """
    database, suffix = options.database, options.suffix
    published = fact_loads(spark, database, suffix)
    old, covered = stored_states(spark, database, suffix)
    if not set(covered) <= set(published):  # a load was taken away
        old, covered = {}, []
    fresh = [i for i in published if i not in set(covered)]
    states = old
    new = Version(spark, database, suffix, options.buckets, published)
    if fresh or not old:
        states = added_states(old, facts_of(spark, database, suffix, fresh), minute_rows, limits)
    stored = {}
    for base, df in states.items():
        # Exemplars may have whole rows ordered.
        with small_splits(spark) if base == "state_exemplars" else nullcontext():
            stored[base] = new.store(base, df)
    for base, df in derived_tables(stored, lambda m: minute_report_of(m, options.vcores), limits).items():
        new.store(base, df)
    new.show()


def report(
    spark: SparkSession,
    database: str,
    suffix: str,
    metric: str,
    norm_texts: list[str] | None = None,
    top_k: int | None = None,
) -> DataFrame:
    """Ranked report of one metric from the stored tables."""

    def stored(base: str) -> DataFrame:
        return spark.table(table_name(database, base, suffix))

    return metric_report(
        metric,
        stored(f"{metric}_summary"),
        stored("batch_summary"),
        stored("unique_batches"),
        norm_texts,
        top_k,
    )


def series(
    spark: SparkSession, database: str, suffix: str, norm_texts: list[str] | None = None
) -> DataFrame:
    """Minute time series from the stored tables."""
    return minute_series(
        spark.table(table_name(database, "minute_report", suffix)),
        spark.table(table_name(database, "unique_batches", suffix)),
        norm_texts,
    )
