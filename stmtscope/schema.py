"""Column layouts of the trace events, the fact table and the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Input: one row per exported trace event.  ``name`` and ``event_ts`` are flat
# columns so that filters on them reach the file scan.
EVENT = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("actions", T.MapType(T.StringType(), T.StringType())),
    ]
)

# --- Fixed values: names and marks that events and results have to agree on. ---
RPC = "rpc_completed"
BATCH = "sql_batch_completed"
EVENT_TYPES = (RPC, BATCH)

RESET_CALL = "sp_reset_connection"
EXECUTE_PREFIX = "sp_execute"
EXECUTE_SQL_PREFIX = "sp_executesql"
PREPARE_CALL = "sp_prepare"

STRING_MARK = "{STR}"
NUMBER_MARK = "{##}"

# Outcome flag -> result text.
OUTCOMES = {"successful": "OK", "failed": "Error", "aborted": "Abort"}

# Bounds of a load that names none, and cores behind the CPU percentage.
DEFAULT_START = "1900-01-01"
DEFAULT_END = "9999-12-31"
DEFAULT_VCORES = 20

METRICS = (
    "duration",
    "cpu_time",
    "logical_reads",
    "physical_reads",
    "writes",
    "row_count",
)

# Reported total of a metric: (output suffix, integer divisor).
# Times are microseconds; reads and writes are 8-KB pages, 128 to the megabyte.
TOTAL_UNITS = {
    "duration": ("_seconds", 1_000_000),
    "cpu_time": ("_seconds", 1_000_000),
    "logical_reads": ("_mb", 128),
    "physical_reads": ("_mb", 128),
    "writes": ("_mb", 128),
    "row_count": ("", 1),
}

# Percentile column -> percent.
PERCENTILES = {
    "first_quartile": 25,
    "median": 50,
    "third_quartile": 75,
    "percentile_90": 90,
    "percentile_95": 95,
    "percentile_99": 99,
}
# --- End of the fixed values. ---


_LONG, _INT, _TEXT, _TIME = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


BATCHES = _struct(
    event_sequence=_LONG,
    event_type=_TEXT,
    event_ts=_TIME,
    client_pid=_INT,
    client_hostname=_TEXT,
    client_app_name=_TEXT,
    username=_TEXT,
    database_name=_TEXT,
    text_id=_LONG,
    text_data=_TEXT,
    norm_id=_LONG,
    norm_text=_TEXT,
    successful=_INT,
    failed=_INT,
    aborted=_INT,
    **{m: _LONG for m in METRICS},
)

UNIQUE_BATCHES = _struct(
    norm_id=_LONG, event_type=_TEXT, database_name=_TEXT, orig_text=_TEXT, norm_text=_TEXT
)

BATCH_SUMMARY = _struct(
    norm_id=_LONG,
    all_executions=_LONG,
    distinct_executions=_LONG,
    successful_executions=_LONG,
    failed_executions=_LONG,
    aborted_executions=_LONG,
)

METRIC_SUMMARY = _struct(
    norm_id=_LONG,
    metric=_TEXT,
    min=_LONG,
    mean=_LONG,
    max=_LONG,
    total=_LONG,
    total_rank=_INT,
    **{p: _LONG for p in PERCENTILES},
)

MINUTE_REPORT = _struct(
    minute=_TIME,
    database_name=_TEXT,
    norm_id=_LONG,
    execution_count=_LONG,
    duration_us=_LONG,
    cpu_us=_LONG,
    cpu_pct=T.DecimalType(18, 4),  # holds the share of any sum of a bigint, also on one core
    logical_reads_pages=_LONG,
    physical_reads_pages=_LONG,
    writes_pages=_LONG,
    avg_row_count=_LONG,
)

# What summaries keep besides their tables, so that further loads can be added to it.
STATE_COUNTS = _struct(norm_id=_LONG, executions=_LONG, successful=_LONG, failed=_LONG, aborted=_LONG)
STATE_TEXTS = _struct(norm_id=_LONG, text_id=_LONG)
STATE_PROFILES = _struct(norm_id=_LONG, **{m: _LONG for m in METRICS})
STATE_VALUES = _struct(norm_id=_LONG, metric_no=_INT, value=_LONG, cnt=_LONG)
STATE_MINUTES = _struct(
    minute=_TIME,
    database_name=_TEXT,
    norm_id=_LONG,
    **{
        c: _LONG
        for c in (
            "execution_count", "duration_us", "cpu_us", "logical_reads_pages", "physical_reads_pages",
            "writes_pages", "row_total", "row_filled",
        )
    },
)
STATE_EXEMPLARS = _struct(
    norm_id=_LONG, event_sequence=_LONG, text_id=_LONG, event_type=_TEXT, database_name=_TEXT, orig_text=_TEXT, norm_text=_TEXT
)
# One row per file of a load; a file with a problem was not loaded.
LOADED_FILE = _struct(
    load_id=_TEXT, file_name=_TEXT, bytes=_LONG, modified=_TIME,
    events_read=_LONG, events_kept=_LONG, events_rejected=_LONG, events_filtered=_LONG, problem=_TEXT,
)


def wide_metric_columns(metric: str) -> dict[str, str]:
    """Long-form column -> column of the per-metric table."""
    names = {
        "min": f"min_{metric}",
        "mean": f"mean_{metric}",
        "max": f"max_{metric}",
        "total": f"total_{metric}",
        "total_rank": f"total_{metric}_rank",
    }
    names.update({p: f"{p}_{metric}" for p in PERCENTILES})
    return names


def wide_metric_summary(metric: str) -> T.StructType:
    """Schema of one per-metric summary table."""
    names = wide_metric_columns(metric)
    return T.StructType(
        [
            T.StructField(names.get(f.name, f.name), f.dataType)
            for f in METRIC_SUMMARY
            if f.name != "metric"
        ]
    )
