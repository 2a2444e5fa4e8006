"""

``entry`` runs the flagship report; ``queries`` has one entry per operator; each one
reads whole tables.  ``oracle_sql`` gives the equivalent SQL over the same tables.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from contextlib import contextmanager
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from stmtscope import operators as ops  # noqa: E402
from stmtscope.functions import (  # noqa: E402
    fingerprint_text,
    norm_id,
    normalize_sql,
    qualified_name,
    text_id,
)
from stmtscope.operators.staging import checkpointed, delete_folder, move_file, new_folder  # noqa: E402
from stmtscope.plans import LoadOptions, load, metric_report, minute_report, minute_series, summarize  # noqa: E402
from stmtscope.schema import BATCHES, METRICS  # noqa: E402
from stmtscope.sources import (  # noqa: E402
    TABLES,
    DuplicateKeyError,
    append_batches,
    cluster_facts,
    create_tables,
    fact_loads,
    load_stats,
    loaded_files,
    new_load,
    read_events,
    table_name,
    write_tables,
)
from stmtscope.sources import clashing_keys as find_clashes  # noqa: E402
from workload import derive, oracle  # noqa: E402

try:
    from stmtscope.llm import queries as llm  # noqa: E402
except ImportError as error:  # the subpackage may have been taken out
    if error.name not in ("stmtscope.llm", "corpus_pipeline"):
        raise
    llm = None

# Names of the per-metric queries.
SHORT = {"cpu_time": "cpu"}
TEXT_SUBSET = (
    "usp_LogClick",
    "SELECT * FROM dbo.Views WHERE u = {##} AND d = {##}",
    "INSERT INTO dbo.Users VALUES ({##}, {STR})",
)
WINDOW = ("2024-01-05 01:30:00", "2024-01-20 18:45:10", "-03:30")
TOP_K = 5
REPEATED = 997  # event sequences are taken modulo this where they are to repeat


def _plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, the type the checking engine uses."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else f.name
            for f in df.schema
        ]
    )


def _summary(batches: DataFrame, metric: str) -> DataFrame:
    return ops.wide_metric_summary(ops.metric_summary(batches, [metric]), metric)


def _report(batches: DataFrame, metric: str, **options) -> DataFrame:
    return metric_report(
        metric,
        _summary(batches, metric),
        ops.batch_summary(batches),
        ops.unique_batches(batches),
        **options,
    )


# --- load ---


def event_type_filter(spark, sf_dir):
    kept = ops.keep_event_types(derive.flat_events(spark, sf_dir))
    return _plain_times(kept.select("event_sequence", "name", "event_ts"))


def connection_reset_filter(spark, sf_dir):
    kept = ops.drop_connection_resets(derive.flat_events(spark, sf_dir), F.col("object_name"))
    return kept.select("event_sequence", "name", "object_name")


def time_range_filter(spark, sf_dir):
    start, end, offset = WINDOW
    kept = ops.within_time_range(derive.flat_events(spark, sf_dir), start, end, offset)
    return _plain_times(kept.select("event_sequence", "name", "event_ts"))


def flatten_events(spark, sf_dir):
    rows = ops.flatten_events(ops.keep_event_types(derive.trace_events(spark, sf_dir)))
    generated = ("text_id", "norm_id", "norm_text")
    return _plain_times(rows.select(*[c for c in BATCHES.fieldNames() if c not in generated]))


def outcome_flags(spark, sf_dir):
    flags = ops.outcome_flags(F.col("result"))
    return derive.flat_events(spark, sf_dir).select(
        "event_sequence", "result", *[c.alias(n) for n, c in flags.items()]
    )


def normalize_text(spark, sf_dir):
    return derive.flat_events(spark, sf_dir).select(
        "event_sequence", normalize_sql(F.col("text_data")).alias("norm_text")
    )


def normalize_documents(spark, sf_dir):
    """Whole documents, once as they are (quotes left open and all) and once as the string
    literal of an INSERT."""
    quote = F.lit("'")
    literal = F.replace(F.col("text"), quote, F.lit("''"))
    insert = F.concat(F.lit("INSERT dbo.Docs VALUES ("), F.col("doc_id"), F.lit(", N'"), literal, F.lit("')"))
    return derive.read_table(spark, sf_dir, "documents").select(
        "doc_id",
        normalize_sql(F.col("text")).alias("norm_text"),
        normalize_sql(insert).alias("norm_insert"),
    )


def normalize_pages(spark, sf_dir):
    return derive.read_table(spark, sf_dir, "pages").select(
        "page_id", normalize_sql(F.col("html")).alias("norm_text")
    )


def _nested(spark, sf_dir):
    return derive.flat_events(spark, sf_dir).withColumn("text_data", F.expr(derive.NESTED_TEXT))


def normalize_nested_comments(spark, sf_dir):
    """Statements with comments in comments, up to forty deep."""
    return _nested(spark, sf_dir).select("event_sequence", normalize_sql(F.col("text_data")).alias("norm_text"))


def normalize_rejected(spark, sf_dir):
    """The same, where a statement that leaves something open has no text."""
    text = normalize_sql(F.col("text_data"), reject_unbalanced=True)
    return _nested(spark, sf_dir).select("event_sequence", text.alias("norm_text"))


def qualified_names(spark, sf_dir):
    calls = derive.flat_events(spark, sf_dir).where(F.col("name") == "rpc_completed")
    return calls.select(
        "event_sequence", qualified_name(F.col("text_data"), F.col("object_name")).alias("qualified")
    )


def fingerprints(spark, sf_dir):
    kept = ops.keep_event_types(derive.flat_events(spark, sf_dir))
    route = fingerprint_text(F.col("name"), F.col("object_name"), F.col("text_data"))
    return kept.withColumn("norm_text", route).select(
        "event_sequence",
        text_id(F.col("text_data")).alias("text_id"),
        norm_id(F.col("database_name"), F.col("norm_text")).alias("norm_id"),
        "norm_text",
    )


def fingerprints_with_schema(spark, sf_dir):
    events = derive.trace_events(spark, sf_dir)
    good, _ = ops.to_batches(events, capture_schema_name=True, filter_connection_resets=True)
    return good.groupBy("database_name", "norm_text").agg(F.count("*").alias("executions"))


def load_batches(spark, sf_dir):
    good, _ = ops.to_batches(derive.trace_events(spark, sf_dir), filter_connection_resets=True)
    return _plain_times(good)


def load_batches_lineitem(spark, sf_dir):
    good, _ = ops.to_batches(derive.trace_events(spark, sf_dir, "lineitem"))
    return _plain_times(good)


def _damaged(spark, sf_dir):
    """Trace events of which some lack a key or hold a value that is no number."""
    place = F.col("event_sequence") % 25
    return derive.as_trace_events(
        derive.flat_events(spark, sf_dir),
        duration=F.when(place == 7, F.lit("n/a")).otherwise(F.col("duration").cast("string")),
        writes=F.when(place != 8, F.col("writes").cast("string")),
        client_pid=F.when(place != 9, F.col("client_pid").cast("string")),
    )


def rejected_events(spark, sf_dir):
    _, rejects = ops.to_batches(_damaged(spark, sf_dir))
    return _plain_times(rejects)


def file_load_stats(spark, sf_dir):
    events = derive.trace_events(spark, sf_dir, file_name=True)
    stats = load_stats(ops.flatten_all(events, filter_connection_resets=True))
    # Part-file names differ from run to run, so the files of the folder are added up.
    counts = [c for c in stats.columns if c != "file_name"]
    return stats.agg(*[F.sum(c).alias(c) for c in counts])


def _damaged_lines(spark, sf_dir):
    """Folder of JSON lines, some of them cut off and some with a time that is none."""
    folder = new_folder(spark)
    place = F.col("event_sequence") % 25
    flat = derive.flat_events(spark, sf_dir)
    packed = derive.as_trace_events(flat.withColumn("place", place), keep=("event_sequence", "place"))
    event = F.struct("name", F.when(F.col("place") == 4, "no time").otherwise(F.col("event_ts").cast("string")).alias("event_ts"), "fields", "actions")
    line = F.to_json(event)
    cut = F.concat(F.lit("{"), F.col("event_sequence").cast("string"))
    packed.select(F.when(F.col("place") == 3, cut).otherwise(line)).write.text(folder)
    return folder


def rejected_lines(spark, sf_dir):
    folder = _damaged_lines(spark, sf_dir)
    try:
        _, rejects = ops.to_batches(read_events(spark, folder, "part-*"))
        return checkpointed(rejects.select("event_sequence", "raw_line", "reject_reason"))
    finally:
        delete_folder(spark, folder)


def load_balance(spark, sf_dir):
    """Every line read is kept, rejected or filtered."""
    folder = _damaged_lines(spark, sf_dir)
    try:
        rows = ops.flatten_all(read_events(spark, folder, "part-*"), filter_connection_resets=True)
        stats = load_stats(rows)
        return checkpointed(stats.agg(*[F.sum(c).alias(c) for c in stats.columns if c != "file_name"]))
    finally:
        delete_folder(spark, folder)


@contextmanager
def _database(spark):
    """A database in a folder of its own, both deleted at the end."""
    location = new_folder(spark)
    name = Path(location).name.replace("-", "_")
    try:
        yield name, location
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        delete_folder(spark, location)


def _job_options(spark, sf_dir, database, location, **options):
    path = options["path"] if "path" in options else derive.trace_folder(spark, sf_dir)
    return LoadOptions(
        **{
            "path": path,
            "pattern": "*.parquet",
            "fmt": "parquet",
            "database": database,
            "location": location,
            "suffix": "_job",
            "filter_connection_resets": True,
        }
        | options
    )


def load_job(spark, sf_dir):
    """The whole load: facts read back from the table; a second load is refused."""
    with _database(spark) as (database, location):
        options = _job_options(spark, sf_dir, database, location)
        load(spark, options)
        try:
            load(spark, options)
        except DuplicateKeyError:
            return checkpointed(_plain_times(spark.table(table_name(database, "batches", "_job"))))
        raise AssertionError("the second load was not refused")


def cluster_facts_job(spark, sf_dir):
    """Facts laid out anew, added up by fingerprint and day."""
    with _database(spark) as (database, location):
        create_tables(spark, database, location=location)
        append_batches(derive.fact_table(spark, sf_dir, "lineitem"), database)
        cluster_facts(spark, database, files=16)
        stored = spark.table(table_name(database, "batches"))
        day = F.date_trunc("day", "event_ts")
        return checkpointed(_plain_times(stored.groupBy("norm_id", day.alias("day")).agg(F.count("*").alias("executions"), F.sum("duration").alias("duration"))))


def load_job_hashed_keys(spark, sf_dir):
    """Keys that are hashes: two of three loads are added; the one between them holds some keys
    of the first and is refused."""
    facts = derive.fact_table(spark, sf_dir, "lineitem")
    old, clash = F.col("event_sequence") % 3 != 0, F.col("event_sequence") % 1000 == 1
    with _database(spark) as (database, location):
        create_tables(spark, database, location=location)
        append_batches(facts.where(old), database)
        try:
            append_batches(facts.where(~old | clash), database)
            raise AssertionError("keys of the first load were taken again")
        except DuplicateKeyError:
            append_batches(facts.where(~old), database)
        stored = spark.table(table_name(database, "batches"))
        return checkpointed(stored.select("event_sequence", "norm_id", "text_data", *METRICS))


def clashing_keys(spark, sf_dir):
    """Keys of a new load that two published ones hold, and which of them."""
    facts = derive.fact_table(spark, sf_dir, "lineitem")
    third = F.col("event_sequence") % 3
    with _database(spark) as (database, location):
        create_tables(spark, database, location=location)
        append_batches(facts.where(third == 1), database)
        append_batches(facts.where(third == 2), database)
        new = new_load(spark, database)
        new.write_facts(facts.where((third == 0) | (F.col("event_sequence") % 1000 == 1)))
        loads = F.array(*[F.lit(i) for i in fact_loads(spark, database)])
        found = find_clashes(new)
        return checkpointed(found.select("event_sequence", F.array_position(loads, F.col("load_id")).alias("load_no")))


def _summaries(spark, options):
    """One row per fingerprint from all derived tables."""
    stored = {base: spark.table(table_name(options.database, base, options.suffix)) for base in TABLES}
    minutes = stored["minute_report"].groupBy("norm_id").agg(F.count("*").alias("minutes"), F.sum("duration_us").alias("duration_us"))
    joined = stored["unique_batches"].join(stored["batch_summary"], "norm_id").join(minutes, "norm_id")
    for metric in METRICS:
        joined = joined.join(stored[f"{metric}_summary"], "norm_id")
    return checkpointed(joined)


def summarize_job(spark, sf_dir):
    """Load and summary jobs; all derived tables read back."""
    with _database(spark) as (database, location):
        options = _job_options(spark, sf_dir, database, location)
        load(spark, options)
        summarize(spark, options)
        return _summaries(spark, options)


def summarize_incremental(spark, sf_dir):
    """Two loads, each followed by a summary; the second reads the new facts only."""
    facts = derive.fact_table(spark, sf_dir)
    first = F.col("event_sequence") % 3 == 0
    with _database(spark) as (database, location):
        options = _job_options(spark, sf_dir, database, location, path="")  # facts are appended, no folder is read
        create_tables(spark, database, options.suffix, location)
        for part in (first, ~first):
            append_batches(facts.where(part), database, options.suffix)
            summarize(spark, options)
        return _summaries(spark, options)


def summarize_incremental_large(spark, sf_dir):
    """The same over a larger table, by the plans of fingerprints too large or too many."""
    facts = derive.fact_table(spark, sf_dir, "lineitem")
    first = F.col("event_sequence") % 3 == 0
    limits = ops.PlanLimits(group_rows=1000, broadcast_fingerprints=500, window_fingerprints=0, filter_log_words=8)
    with _database(spark) as (database, location):
        options = _job_options(spark, sf_dir, database, location, path="")  # facts are appended, no folder is read
        create_tables(spark, database, options.suffix, location)
        for part in (first, ~first):
            append_batches(facts.where(part), database, options.suffix)
            summarize(spark, options, limits)
        return _summaries(spark, options)


FILES = 8


def load_stats_per_file(spark, sf_dir):
    """Counts of a load, by file."""
    with _database(spark) as (database, location):
        folder = f"{location}/traces"
        derive.named_files(spark, derive.flat_events(spark, sf_dir), F.col("event_sequence") % FILES, folder)
        stats, _ = load(spark, _job_options(spark, sf_dir, database, location, path=folder, pattern="*.json", fmt="json"))
        return checkpointed(stats)


def scan_new_files(spark, sf_dir):
    """A folder that grows, loaded three times: each file comes with the first load that sees it."""
    flat, part = derive.flat_events(spark, sf_dir), F.col("event_sequence") % FILES
    with _database(spark) as (database, location):
        folder = f"{location}/traces"
        options = _job_options(spark, sf_dir, database, location, path=folder, pattern="*.json", fmt="json", only_new_files=True)
        for wave in (part < 5, part >= 5):
            derive.named_files(spark, flat.where(wave), part, folder)
            load(spark, options)
        load(spark, options)
        loads = F.array(*[F.lit(i) for i in fact_loads(spark, database, options.suffix)])
        known = loaded_files(new_load(spark, database, options.suffix))
        counts = [c for c in known.columns if c.startswith("events_")]
        return checkpointed(known.select("file_name", F.array_position(loads, F.col("load_id")).alias("load_no"), *counts))


def rejected_files(spark, sf_dir):
    """Files that no reader can read are set aside with a reason; the others are loaded."""
    with _database(spark) as (database, location):
        folder = f"{location}/traces"
        derive.named_files(spark, derive.flat_events(spark, sf_dir), F.col("event_sequence") % FILES, folder)
        for damaged in (3, 6):  # text that calls itself compressed
            move_file(spark, f"{folder}/trace_{damaged}.json", f"{folder}/trace_{damaged}.json.gz")
        options = _job_options(spark, sf_dir, database, location, path=folder, pattern="*.json*", fmt="json", skip_damaged_files=True)
        stats, rejects = load(spark, options)
        return checkpointed(stats.join(rejects.select("file_name", "reject_reason"), "file_name", "left"))


def scan_event_folder(spark, sf_dir):
    folder = new_folder(spark)
    try:
        stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
        events = derive.as_trace_events(derive.flat_events(spark, sf_dir))
        events.write.option("timestampFormat", stamp).json(folder)
        good, _ = ops.to_batches(read_events(spark, folder, "part-*.json", file_name=False), filter_connection_resets=True)
        return checkpointed(_plain_times(good))
    finally:
        delete_folder(spark, folder)


def duplicate_keys(spark, sf_dir):
    lines = derive.read_table(spark, sf_dir, "lineitem")
    keyed = lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_sequence"))
    return ops.duplicate_keys(keyed)


def write_and_read_back(spark, sf_dir):
    with _database(spark) as (database, location):
        create_tables(spark, database, "_check", location)
        append_batches(derive.fact_table(spark, sf_dir), database, "_check")
        stored = spark.table(table_name(database, "batches", "_check"))
        write_tables({"batch_summary": ops.batch_summary(stored)}, database, "_check", buckets=4)
        return checkpointed(spark.table(table_name(database, "batch_summary", "_check")))


# --- derived tables and reports ---


def unique_batches(spark, sf_dir):
    return ops.unique_batches(derive.fact_table(spark, sf_dir))


def unique_batches_single_pass(spark, sf_dir):
    return ops.exemplars_by_aggregate(derive.fact_table(spark, sf_dir))


def _repeated_keys(spark, sf_dir):
    """Facts whose event sequences repeat inside fingerprints."""
    facts = derive.fact_table(spark, sf_dir, "lineitem")
    return facts.withColumn("event_sequence", F.col("event_sequence") % REPEATED)


def unique_batches_repeated_keys(spark, sf_dir):
    return ops.unique_batches(_repeated_keys(spark, sf_dir))


def unique_batches_many(spark, sf_dir):
    """The way taken when the fingerprints are too many to broadcast."""
    return ops.unique_batches(_repeated_keys(spark, sf_dir), ops.PlanLimits(broadcast_fingerprints=0))


def batch_summary(spark, sf_dir):
    return ops.batch_summary(derive.fact_table(spark, sf_dir))


def numbered_executions(spark, sf_dir):
    return ops.numbered_executions(derive.fact_table(spark, sf_dir), "duration")


def numbered_executions_lineitem(spark, sf_dir):
    return ops.numbered_executions(derive.fact_table(spark, sf_dir, "lineitem"), "writes")


def metric_summaries_large(spark, sf_dir):
    """The way of fingerprints too large for one task, for all of them; ranks by join."""
    limits = ops.PlanLimits(group_rows=0, broadcast_fingerprints=0, broadcast_ranks=0, window_fingerprints=0)
    return ops.metric_summary(derive.fact_table(spark, sf_dir, "lineitem"), limits=limits)


def dense_rank_large(spark, sf_dir):
    """Total ranks when the fingerprints are too many for one task per metric."""
    limits = ops.PlanLimits(window_fingerprints=0)
    ranked = ops.metric_summary(derive.fact_table(spark, sf_dir, "lineitem"), ["duration"], limits)
    return ranked.select("norm_id", "total", "total_rank")


def metric_summaries(spark, sf_dir):
    return ops.metric_summary(derive.fact_table(spark, sf_dir))


def metric_summaries_lineitem(spark, sf_dir):
    return ops.metric_summary(derive.fact_table(spark, sf_dir, "lineitem"))


def batch_summary_lineitem(spark, sf_dir):
    return ops.batch_summary(derive.fact_table(spark, sf_dir, "lineitem"))


def unique_batches_lineitem(spark, sf_dir):
    return ops.unique_batches(derive.fact_table(spark, sf_dir, "lineitem"))


def _minutes(batches: DataFrame) -> DataFrame:
    """The minute report with the share in the type that the SQL gives it."""
    return minute_report(batches).withColumn("cpu_pct", F.col("cpu_pct").cast("decimal(7,4)"))


def minute_rollup(spark, sf_dir):
    return _plain_times(_minutes(derive.fact_table(spark, sf_dir)))


def minute_time_series(spark, sf_dir):
    batches = derive.fact_table(spark, sf_dir)
    return _plain_times(minute_series(_minutes(batches), ops.unique_batches(batches)))


def minute_series_subset(spark, sf_dir):
    batches = derive.fact_table(spark, sf_dir)
    return _plain_times(minute_series(_minutes(batches), ops.unique_batches(batches), TEXT_SUBSET))


def report_long_text_list(spark, sf_dir):
    """A list too long for literals: the wanted texts among many others."""
    texts = (*TEXT_SUBSET, *(f"SELECT {i} FROM dbo.Other" for i in range(1000)))
    return _report(derive.fact_table(spark, sf_dir), "duration", norm_texts=texts)


def _with_place(df):
    """The place of each row in the order in which a report returns its rows."""
    stored = checkpointed(df.withColumn("at", F.monotonically_increasing_id()))
    rows = stored.withColumn("part", F.shiftright("at", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = rows.groupBy("part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    offsets = parts.select("part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("offset"))
    return rows.join(offsets, "part").withColumn("place", F.col("at") + F.col("offset"))


def report_order(spark, sf_dir):
    return _with_place(_report(derive.fact_table(spark, sf_dir), "duration")).select("total_duration_seconds", "place")


def minute_series_order(spark, sf_dir):
    return _with_place(_plain_times(minute_time_series(spark, sf_dir))).select("minute", "place")


def report_text_subset(spark, sf_dir):
    return _report(derive.fact_table(spark, sf_dir), "duration", norm_texts=TEXT_SUBSET)


def report_top_k(spark, sf_dir):
    return _report(derive.fact_table(spark, sf_dir), "duration", top_k=TOP_K)


def _summary_query(metric):
    return lambda spark, sf_dir: _summary(derive.fact_table(spark, sf_dir), metric)


def _report_query(metric):
    return lambda spark, sf_dir: _report(derive.fact_table(spark, sf_dir), metric)


SMALLEST = "/root/testdata/sf0.001"  # the contract gives entry() no folder


def entry(spark: SparkSession) -> DataFrame:
    """Duration report over the events of the smallest scale."""
    return _report(derive.fact_table(spark, SMALLEST), "duration")


def trace_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {
        "event_type_filter": event_type_filter,
        "connection_reset_filter": connection_reset_filter,
        "time_range_filter": time_range_filter,
        "flatten_events": flatten_events,
        "outcome_flags": outcome_flags,
        "normalize_text": normalize_text,
        "normalize_documents": normalize_documents,
        "normalize_pages": normalize_pages,
        "normalize_nested_comments": normalize_nested_comments,
        "normalize_rejected": normalize_rejected,
        "qualified_name": qualified_names,
        "fingerprints": fingerprints,
        "fingerprints_with_schema": fingerprints_with_schema,
        "load_batches": load_batches,
        "load_batches_lineitem": load_batches_lineitem,
        "rejected_events": rejected_events,
        "load_stats": file_load_stats,
        "rejected_lines": rejected_lines,
        "load_balance": load_balance,
        "load_job": load_job,
        "load_job_hashed_keys": load_job_hashed_keys,
        "clashing_keys": clashing_keys,
        "cluster_facts": cluster_facts_job,
        "summarize_job": summarize_job,
        "summarize_incremental": summarize_incremental,
        "summarize_incremental_large": summarize_incremental_large,
        "load_stats_per_file": load_stats_per_file,
        "scan_new_files": scan_new_files,
        "rejected_files": rejected_files,
        "scan_event_folder": scan_event_folder,
        "duplicate_keys": duplicate_keys,
        "write_and_read_back": write_and_read_back,
        "unique_batches": unique_batches,
        "unique_batches_single_pass": unique_batches_single_pass,
        "unique_batches_lineitem": unique_batches_lineitem,
        "batch_summary": batch_summary,
        "batch_summary_lineitem": batch_summary_lineitem,
        "numbered_executions": numbered_executions,
        "metric_summaries": metric_summaries,
        "metric_summaries_lineitem": metric_summaries_lineitem,
        "minute_report": minute_rollup,
        "minute_series": minute_time_series,
        "report_text_subset": report_text_subset,
        "report_top_k": report_top_k,
        "unique_batches_repeated_keys": unique_batches_repeated_keys,
        "unique_batches_many": unique_batches_many,
        "numbered_executions_lineitem": numbered_executions_lineitem,
        "metric_summaries_large": metric_summaries_large,
        "dense_rank_large": dense_rank_large,
        "minute_series_subset": minute_series_subset,
        "report_long_text_list": report_long_text_list,
        "report_order": report_order,
        "minute_series_order": minute_series_order,
    }
    for metric in METRICS:
        short = SHORT.get(metric, metric)
        named[f"{short}_summary"] = _summary_query(metric)
        named[f"{short}_report"] = _report_query(metric)
    return named


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return trace_queries() | (llm.queries() if llm else {})


def trace_sql() -> dict[str, str]:
    raw = oracle.RAW["events"]
    events = oracle.batches_with("events")
    lines = oracle.batches_with("lineitem", drop_resets=False)
    all_calls = oracle.batches_with("events", drop_resets=False)
    generated = ("text_id", "norm_id", "norm_text")
    flat = ", ".join(c for c in BATCHES.fieldNames() if c not in generated)
    every = ", ".join(BATCHES.fieldNames())
    chosen = f"{oracle.KEPT} AND NOT {oracle.RESET}"
    names = ", ".join(oracle.quoted(t) for t in TEXT_SUBSET)
    repeated = lines.replace(
        "  SELECT event_sequence, name AS event_type", f"  SELECT event_sequence % {REPEATED} AS event_sequence, name AS event_type"
    )
    series = (
        "SELECT minute, m.norm_id, m.database_name, norm_text, execution_count, duration_us, cpu_us, cpu_pct, "
        "logical_reads_pages, physical_reads_pages, writes_pages, avg_row_count "
        f"FROM ({oracle.MINUTES}) m JOIN ({oracle.UNIQUE}) u ON u.norm_id = m.norm_id"
    )

    nested = (
        f"WITH RECURSIVE raw AS (SELECT event_sequence, {derive.NESTED_TEXT} AS text_data FROM ({raw})), "
        f"{oracle.flat_ctes('raw', 'event_sequence', 'text_data')}, {oracle.norm_ctes('flat', 'id', 'text')}"
    )
    per_file = (
        f"count(*) FILTER (WHERE true) AS events_read, count(*) FILTER (WHERE {chosen}) AS events_kept, "
        f"0::BIGINT AS events_rejected, count(*) FILTER (WHERE NOT ({chosen})) AS events_filtered"
    )
    summaries = (
        f"SELECT * FROM ({oracle.UNIQUE}) JOIN ({oracle.COUNTS}) USING (norm_id) "
        f"JOIN (SELECT norm_id, count(*) AS minutes, CAST(sum(duration_us) AS BIGINT) AS duration_us FROM ({oracle.MINUTES}) GROUP BY norm_id) "
        "USING (norm_id) " + " ".join(f"JOIN ({oracle.wide_summary(m)}) USING (norm_id)" for m in METRICS)
    )

    def numbered(metric):
        return (
            f"SELECT norm_id, event_sequence, {metric}, row_number() OVER (PARTITION BY norm_id ORDER BY {metric} ASC "
            "NULLS FIRST, event_sequence) AS execution_number, count(*) OVER (PARTITION BY norm_id) AS execution_count FROM batches"
        )

    sql = {
        "event_type_filter": f"SELECT event_sequence, name, event_ts FROM ({raw}) WHERE {oracle.KEPT}",
        "connection_reset_filter": f"SELECT event_sequence, name, object_name FROM ({raw}) WHERE NOT {oracle.RESET}",
        # 01:30 and 18:45:10 at -03:30 are 05:00 and 22:15:10 in UTC.
        "time_range_filter": f"SELECT event_sequence, name, event_ts FROM ({raw}) WHERE event_ts BETWEEN "
        "TIMESTAMP '2024-01-05 05:00:00' AND TIMESTAMP '2024-01-20 22:15:10'",
        "flatten_events": f"{all_calls} SELECT {flat} FROM batches",
        "outcome_flags": "SELECT event_sequence, result, CASE WHEN result = 'OK' THEN 1 ELSE 0 END AS successful, "
        "CASE WHEN result = 'Error' THEN 1 ELSE 0 END AS failed, "
        f"CASE WHEN result = 'Abort' THEN 1 ELSE 0 END AS aborted FROM ({raw})",
        "normalize_text": f"WITH raw AS ({raw}), {oracle.norm_ctes('raw', 'event_sequence', 'text_data')} "
        "SELECT id AS event_sequence, norm_text FROM norm",
        "normalize_documents": "WITH docs AS (SELECT doc_id, text, 'INSERT dbo.Docs VALUES (' || doc_id || ', N''' "
        "|| replace(text, '''', '''''') || ''')' AS insert_text FROM documents), "
        f"{oracle.norm_ctes('docs', 'doc_id', 'text', 'a_')}, "
        f"{oracle.norm_ctes('docs', 'doc_id', 'insert_text', 'b_')} "
        "SELECT doc_id, coalesce(a_norm.norm_text, '') AS norm_text, b_norm.norm_text AS norm_insert "
        "FROM docs LEFT JOIN a_norm ON a_norm.id = doc_id LEFT JOIN b_norm ON b_norm.id = doc_id",
        "normalize_pages": f"WITH {oracle.norm_ctes('pages', 'page_id', 'html')} "
        "SELECT page_id, coalesce(norm_text, '') AS norm_text FROM pages LEFT JOIN norm ON norm.id = page_id",
        "normalize_nested_comments": f"{nested} SELECT id AS event_sequence, norm_text FROM norm",
        "normalize_rejected": f"{nested} SELECT id AS event_sequence, CASE WHEN bad THEN '' ELSE norm_text END AS norm_text "
        f"FROM norm JOIN (SELECT id, bool_or({oracle.OPEN}) AS bad FROM tokens GROUP BY id) USING (id)",
        "qualified_name": f"SELECT event_sequence, {oracle.qualified_name('text_data', 'object_name')} AS qualified "
        f"FROM ({raw}) WHERE name = 'rpc_completed'",
        "fingerprints": f"{all_calls} SELECT event_sequence, text_id, norm_id, norm_text FROM batches",
        "fingerprints_with_schema": f"{events}, captured AS (SELECT b.database_name, "
        f"CASE WHEN b.event_type = 'rpc_completed' AND NOT {oracle.DYNAMIC} "
        f"THEN {oracle.qualified_name('k.text_data', 'k.object_name')} ELSE b.norm_text END AS norm_text "
        "FROM batches b JOIN kept k ON k.event_sequence = b.event_sequence) "
        "SELECT database_name, norm_text, count(*) AS executions FROM captured GROUP BY 1, 2",
        "load_batches": f"{events} SELECT {every} FROM batches",
        "load_batches_lineitem": f"{lines} SELECT {every} FROM batches",
        "rejected_events": f"SELECT event_sequence, name AS event_type, event_ts, CASE event_sequence % 25 "
        "WHEN 7 THEN 'invalid duration' WHEN 8 THEN 'missing writes' ELSE 'missing client_pid' END AS reject_reason "
        f"FROM ({raw}) WHERE {oracle.KEPT} AND event_sequence % 25 IN (7, 8, 9)",
        "load_stats": f"SELECT count(*) AS events_read, count(*) FILTER (WHERE {chosen}) AS events_kept, "
        f"0::BIGINT AS events_rejected, count(*) FILTER (WHERE NOT ({chosen})) AS events_filtered FROM ({raw})",
        "rejected_lines": f"SELECT CASE WHEN event_sequence % 25 = 4 THEN event_sequence END AS event_sequence, "
        "CASE WHEN event_sequence % 25 = 3 THEN '{' || event_sequence END AS raw_line, "
        "CASE WHEN event_sequence % 25 = 3 THEN 'unreadable line' ELSE 'invalid event_ts' END AS reject_reason "
        f"FROM ({raw}) WHERE event_sequence % 25 = 3 OR (event_sequence % 25 = 4 AND {oracle.KEPT})",
        "load_balance": f"SELECT count(*) AS events_read, count(*) FILTER (WHERE {chosen} AND place NOT IN (3, 4)) AS events_kept, "
        f"count(*) FILTER (WHERE place = 3 OR (place = 4 AND {chosen})) AS events_rejected, "
        f"count(*) FILTER (WHERE place <> 3 AND NOT ({chosen})) AS events_filtered "
        f"FROM (SELECT *, event_sequence % 25 AS place FROM ({raw}))",
        "load_job": f"{events} SELECT {every} FROM batches",
        "load_job_hashed_keys": f"{lines} SELECT event_sequence, norm_id, text_data, {', '.join(METRICS)} FROM batches",
        "cluster_facts": f"{lines} SELECT norm_id, date_trunc('day', event_ts) AS day, count(*) AS executions, "
        "CAST(sum(duration) AS BIGINT) AS duration FROM batches GROUP BY 1, 2",
        "clashing_keys": f"{lines} SELECT event_sequence, event_sequence % 3 AS load_no FROM batches "
        "WHERE event_sequence % 1000 = 1 AND event_sequence % 3 <> 0",
        "load_stats_per_file": f"SELECT 'trace_' || event_sequence % {FILES} || '.json' AS file_name, {per_file} FROM ({raw}) GROUP BY 1",
        "scan_new_files": f"SELECT 'trace_' || event_sequence % {FILES} || '.json' AS file_name, "
        f"any_value(CASE WHEN event_sequence % {FILES} < 5 THEN 1 ELSE 2 END) AS load_no, {per_file} FROM ({raw}) GROUP BY 1",
        "rejected_files": f"SELECT 'trace_' || event_sequence % {FILES} || CASE WHEN event_sequence % {FILES} IN (3, 6) THEN '.json.gz' ELSE '.json' END "
        "AS file_name, " + per_file.replace("(WHERE ", f"(WHERE event_sequence % {FILES} NOT IN (3, 6) AND ")
        + f", any_value(CASE WHEN event_sequence % {FILES} IN (3, 6) THEN 'unreadable file' END) AS reject_reason FROM ({raw}) GROUP BY 1",
        "summarize_incremental": f"{events} {summaries}",
        "summarize_incremental_large": f"{lines} {summaries}",
        "summarize_job": f"{events} {summaries}",
        "scan_event_folder": f"{events} SELECT {every} FROM batches",
        "duplicate_keys": "SELECT l_orderkey * 10 + l_linenumber AS event_sequence, count(*) AS occurrences "
        "FROM lineitem GROUP BY 1 HAVING count(*) > 1",
        "write_and_read_back": f"{events} {oracle.COUNTS}",
        "unique_batches": f"{events} {oracle.UNIQUE}",
        "unique_batches_single_pass": f"{events} {oracle.UNIQUE}",
        "unique_batches_lineitem": f"{lines} {oracle.UNIQUE}",
        "batch_summary": f"{events} {oracle.COUNTS}",
        "batch_summary_lineitem": f"{lines} {oracle.COUNTS}",
        "numbered_executions": f"{events} {numbered('duration')}",
        "metric_summaries": f"{events} {oracle.long_summary()}",
        "metric_summaries_lineitem": f"{lines} {oracle.long_summary()}",
        "minute_report": f"{events} {oracle.MINUTES}",
        "minute_series": f"{events} {series}",
        "minute_series_subset": f"{events} {series} WHERE norm_text IN ({names})",
        "minute_series_order": f"{events} SELECT minute, row_number() OVER (ORDER BY minute) AS place FROM ({series})",
        "report_order": f"{events} SELECT total_duration_seconds, row_number() OVER (ORDER BY total_duration_seconds DESC) AS place "
        f"FROM ({oracle.report('duration')})",
        "report_long_text_list": f"{events} {oracle.report('duration', f'WHERE u.norm_text IN ({names})')}",
        "unique_batches_repeated_keys": f"{repeated} {oracle.UNIQUE}",
        "unique_batches_many": f"{repeated} {oracle.UNIQUE}",
        "numbered_executions_lineitem": f"{lines} {numbered('writes')}",
        "metric_summaries_large": f"{lines} {oracle.long_summary()}",
        "dense_rank_large": f"{lines} SELECT norm_id, total_duration AS total, total_duration_rank AS total_rank "
        f"FROM ({oracle.wide_summary('duration')})",
        "report_text_subset": f"{events} {oracle.report('duration', f'WHERE u.norm_text IN ({names})')}",
        "report_top_k": f"{events} {oracle.report('duration', f'WHERE s.total_duration_rank <= {TOP_K}')}",
    }
    for metric in METRICS:
        short = SHORT.get(metric, metric)
        sql[f"{short}_summary"] = f"{events} {oracle.wide_summary(metric)}"
        sql[f"{short}_report"] = f"{events} {oracle.report(metric)}"
    return sql


def oracle_sql() -> dict[str, str]:
    return trace_sql() | (llm.oracle_sql() if llm else {})
