"""Work that a large table does not pay for."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from stmtscope.operators import PlanLimits, to_batches
from stmtscope.operators import summaries
from stmtscope.schema import METRICS
from workload import derive

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture()
def nothing_written(monkeypatch):
    monkeypatch.setattr(derive, "_written", {})


def exported():
    return [key for key in derive._written if key[-1] == "trace"]


@pytest.mark.parametrize("source", ["events", "lineitem"])
def test_facts_are_made_without_an_export(spark, nothing_written, source):
    facts = derive.fact_table(spark, SMALLEST, source)
    assert not exported()
    filters = {"filter_connection_resets": True} if source == "events" else {}
    through_files, _ = to_batches(derive.trace_events(spark, SMALLEST, source), **filters)
    assert facts.columns == through_files.columns
    assert facts.count() == through_files.count()
    assert facts.exceptAll(through_files).isEmpty()


def test_a_summary_of_appended_facts_exports_nothing(spark, nothing_written):
    assert contract.summarize_incremental(spark, SMALLEST).count()
    assert not exported()


def plan_of(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_values_beside_the_ranks_are_cut_before_the_shuffle(spark, tmp_path, capsys):
    rows = [(k % 3, *[k * 1_000_003 % 5000 + 10**9] * len(METRICS)) for k in range(600)]
    folder = str(tmp_path / "facts")
    spark.createDataFrame(rows, "norm_id long, " + ", ".join(f"{m} long" for m in METRICS)).write.parquet(folder)
    values = summaries._numbered_values(spark.read.parquet(folder), METRICS, METRICS).withColumn("cnt", F.lit(1))
    buckets = summaries._per_bucket(values)
    assert "metric_no" in buckets.columns and plan_of(buckets, capsys).count("Window [") == 1
    ranks = summaries._open_ranks(summaries._per_group(buckets))
    n = ranks.count()
    assert n
    found = {}
    for name, limits in {"few": PlanLimits(), "many": PlanLimits(broadcast_ranks=0)}.items():
        found[name] = summaries._values_at_ranks(values, ranks, n, limits)
    assert "LeftSemi, BuildRight" in plan_of(found["many"], capsys)
    assert found["few"].exceptAll(found["many"]).isEmpty() and found["many"].exceptAll(found["few"]).isEmpty()
