"""Intermediate results in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Bytes of files in a task that orders or deals whole rows.  Rows in memory are some ten times
# larger than in their files, and a core has a GB or less.
SPLIT_BYTES = 32 << 20
# Of stored rows: texts and sorted numbers come to some three quarters of their size by the default.
COMPRESSION = {"compression": "zstd"}
_SPLIT_OPTION = "spark.sql.files.maxPartitionBytes"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.  Only a local session that
    names none gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # local-cluster is a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="stmtscope-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """Unused folder name below the shared folder."""
    return f"{shared_folder(spark)}/stmtscope-{uuid.uuid4().hex}"


def _path(spark: SparkSession, folder: str):
    """The folder's path and file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all it holds."""
    path, files = _path(spark, folder)
    files.delete(path, True)


def make_folder(spark: SparkSession, folder: str) -> None:
    """Make a folder, if there is none yet."""
    path, files = _path(spark, folder)
    files.mkdirs(path)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder."""
    path, files = _path(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()] if files.exists(path) else []


def file_names(spark: SparkSession, folder: str, ending: str = "") -> list[str]:
    """Names of the files in a folder."""
    path, files = _path(spark, folder)
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isFile()]
    return sorted(n for n in names if n.endswith(ending))


def move_file(spark: SparkSession, old: str, new: str) -> None:
    """Rename a file."""
    path, files = _path(spark, old)
    if not files.rename(path, _path(spark, new)[0]):
        raise OSError(f"cannot move {old} to {new}")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that several readers neither
    recompute it nor depend on any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside read files in splits small enough to be ordered in memory, so that
    a task does not spill its rows.  Smaller splits that the session asks for stay."""
    before = spark.conf.get(_SPLIT_OPTION)
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(_SPLIT_OPTION, str(min(size, SPLIT_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT_OPTION, before)
