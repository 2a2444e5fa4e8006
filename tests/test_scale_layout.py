"""Tasks that order whole rows hold what fits their memory."""

import pytest

from stmtscope.operators import staging
from stmtscope.schema import BATCHES
from stmtscope.sources import append_batches, cluster_facts, create_tables, fact_loads, layout, table_name
from test_loads import database, fact_folder, facts, stored_keys  # noqa: F401  (database is a fixture)

SPLIT = "spark.sql.files.maxPartitionBytes"


def test_wide_rows_are_ordered_in_small_splits(spark, tmp_path, database, monkeypatch):  # noqa: F811
    name, location = database
    create_tables(spark, name, location=location)
    folder = str(tmp_path / "many")
    facts(spark, range(80)).repartition(40).write.parquet(folder)
    before = spark.conf.get(SPLIT)
    monkeypatch.setattr(staging, "SPLIT_BYTES", 1000)
    append_batches(spark.read.schema(BATCHES).parquet(folder), name)
    assert spark.conf.get(SPLIT) == before
    (load_id,) = fact_loads(spark, name)
    assert len(list(fact_folder(spark, name, load_id).glob("rows/*/*.parquet"))) >= 30
    assert stored_keys(spark, name) == list(range(80))


def test_splits_are_never_made_larger(spark):
    before = spark.conf.get(SPLIT)
    try:
        spark.conf.set(SPLIT, "1m")
        with pytest.raises(KeyError), staging.small_splits(spark):
            assert spark.conf.get(SPLIT) == str(1 << 20)
            raise KeyError
        assert spark.conf.get(SPLIT) == "1m"
    finally:
        spark.conf.set(SPLIT, before)


def test_a_large_load_is_clustered_by_more_tasks(spark, database, monkeypatch):  # noqa: F811
    name, location = database
    create_tables(spark, name, location=location)
    append_batches(facts(spark, range(200), text="select a{} from t"), name)
    rows = spark.table(table_name(name, "batches"))
    want = sorted(map(str, rows.collect()))
    assert layout.clustered(rows, 3).rdd.getNumPartitions() == 3
    monkeypatch.setattr(layout, "TASK_BYTES", 4096)
    assert layout.clustered(rows, 3).rdd.getNumPartitions() > 10
    assert layout.clustered(rows.where("false"), 3).count() == 0
    cluster_facts(spark, name, files=3)
    (load_id,) = fact_loads(spark, name)
    assert len(list(fact_folder(spark, name, load_id).glob("clustered-*/*.parquet"))) > 10
    assert sorted(map(str, spark.table(table_name(name, "batches")).collect())) == want
