"""Source: folders of exported trace events (JSON lines, Parquet or ORC)."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stmtscope.operators.flatten import RAW_LINE, READ_PROBLEM, REASON, SELECTED
from stmtscope.schema import EVENT


def read_events(
    spark: SparkSession,
    path: str | list[str],
    pattern: str = "*",
    fmt: str = "json",
    file_name: bool = True,
    **options: str,
) -> DataFrame:
    """All files directly in ``path`` (or of a list of paths) whose name matches ``pattern``, as one
    DataFrame of events, with the name of the file each came from unless ``file_name`` is off.

    JSON events also have ``read_problem`` and ``raw_line``: a line that cannot be read is an
    event with nothing but these, and one whose time cannot be read has no time.  Both
    go on to the rejects.
    """
    source = [plain_file_name().alias("file_name")] if file_name else []
    reader = spark.read.format(fmt).option("pathGlobFilter", pattern)
    if fmt != "json":
        return reader.schema(EVENT).options(**options).load(path).select(*EVENT.fieldNames(), *source)
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "event_ts" else f.dataType) for f in EVENT]
    ).add(RAW_LINE, T.StringType())
    lines = reader.schema(as_text).options(mode="PERMISSIVE", columnNameOfCorruptRecord=RAW_LINE).options(**options).load(path)
    written = [F.lit(options["timestampFormat"])] if "timestampFormat" in options else []
    time = F.try_to_timestamp("event_ts", *written) if written else F.col("event_ts").try_cast("timestamp")
    problem = F.when(F.col(RAW_LINE).isNotNull(), "unreadable line").when(
        F.col("event_ts").isNotNull() & time.isNull(), "invalid event_ts"
    )
    readable = F.col(RAW_LINE).isNull()
    columns = {"event_ts": time, "fields": F.col("fields"), "actions": F.col("actions"), "name": F.col("name")}
    return lines.select(
        *[F.when(readable, columns[c]).alias(c) for c in EVENT.fieldNames()],
        *source,
        problem.alias(READ_PROBLEM),
        RAW_LINE,
    )


def plain_file_name() -> Column:
    """Name of the file a row comes from; Spark gives it as part of a URI."""
    name = F.col("_metadata.file_name")
    return F.when(F.contains(name, F.lit("%")), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)


def listed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Name, path, size and time of the folder's files; no file is opened.  An empty file has
    neither path nor time, since there is nothing to read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    # The list is the one that Spark's driver keeps of any folder it reads.
    names = [(unquote(file.rsplit("/", 1)[-1]),) for file in listed.inputFiles()]
    about = listed.select(
        plain_file_name().alias("file_name"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )
    return spark.createDataFrame(names, "file_name string").join(about, "file_name", "left").fillna(0, "bytes")


def as_plain_path(path: str) -> str:
    """A path that is read as it stands, though it has pattern characters."""
    return re.sub(r"([\\\[\]{}*?,])", r"\\\1", path)


def damaged_files(spark: SparkSession, paths: Sequence[str], read: Callable[[list[str]], DataFrame]) -> dict[str, str]:
    """Files that Spark's reader cannot read to their end, and why.

    The files are read together; as long as some of a set fail, its halves are read.  With
    few damaged files among n that is a few times log2(n) jobs, all but the last ones of many files.
    """
    found: dict[str, str] = {}
    waiting = [list(paths)]
    while waiting:
        some = waiting.pop()
        try:
            read(some).write.format("noop").mode("overwrite").save()
        except Exception as error:  # whatever a reader or codec raises
            if len(some) == 1:
                found[some[0]] = _reason(error)
            else:
                waiting += [some[: len(some) // 2], some[len(some) // 2 :]]
    return found


def _reason(error: Exception) -> str:
    """First line of the innermost cause."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None and cause.getCause() is not None:
        cause = cause.getCause()
    text = str(cause.getMessage()) if cause is not None else str(error)
    return text.strip().splitlines()[0] if text.strip() else type(error).__name__


def load_stats(rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Events read, kept (fact rows), rejected and filtered out, per file.

    ``rows`` are all events, flattened by ``flatten_all``, with their ``file_name``; with
    ``files`` also those without any event are listed.  Nothing is read again.
    """
    selected, good = F.col(SELECTED), F.col(REASON).isNull()
    stats = rows.groupBy("file_name").agg(
        F.count("*").alias("events_read"),
        F.count_if(selected & good).alias("events_kept"),
        F.count_if(selected & ~good).alias("events_rejected"),
        F.count_if(~selected).alias("events_filtered"),
    )
    if files is None:
        return stats
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in stats.columns if c != "file_name"]
    return files.join(stats, "file_name", "left").select("file_name", *counts)
