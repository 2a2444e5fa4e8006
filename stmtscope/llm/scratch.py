"""Intermediate tables of one operator call, in the shared folder of the cluster."""

from __future__ import annotations

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stmtscope.operators.staging import checkpointed, delete_folder, new_folder


def share(spark: SparkSession, value) -> Broadcast:
    """Broadcast of a value whose class travels with it, so that executors need not have this
    package; tasks take it by ``shared_value``."""
    return spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(value)})


def shared_value(shared: Broadcast):
    """The value of ``share``; it is unpacked once per worker and stays for its later tasks."""
    held = shared.value
    if "value" not in held:
        held["value"] = cloudpickle.loads(held.pop("pickled"))
    return held["value"]


class Scratch:
    """Tables written once and read many times.  ``with Scratch(spark) as scratch`` deletes
    them at the end, also after a failure; what is returned goes through ``result``, whose
    checkpoint files Spark's own cleaner removes."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder: str | None = None
        self.count = 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        if self.folder is not None:
            delete_folder(self.spark, self.folder)

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, computed now and read back from Parquet: no lineage, no executor needed."""
        if self.folder is None:
            self.folder = new_folder(self.spark)
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_and_count(self, df: DataFrame, condition) -> tuple[DataFrame, int]:
        """``keep``, and how many rows meet the condition (counted by the same job)."""
        seen = Observation()
        kept = self.keep(df.observe(seen, F.count_if(condition).alias("n")))
        return kept, seen.get["n"]

    @staticmethod
    def result(df: DataFrame) -> DataFrame:
        return checkpointed(df)
