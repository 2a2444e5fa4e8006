"""Summaries of many executions."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stmtscope.operators import PlanLimits, exemplars_by_aggregate, first_occurrences
from stmtscope.operators.summaries import exemplar_candidates, exemplar_rows
from stmtscope.plans import LoadOptions, minute_report, summarize
from stmtscope.schema import BATCHES
from stmtscope.sources import TABLES, Version, append_batches, create_tables, table_name
from test_loads import database, derived_by_hand, facts, many_fingerprints  # noqa: F401  (database is a fixture)

LONGEST = (1 << 63) - 1


@pytest.mark.parametrize("cpu, vcores, want", [(12_000_000_000, 20, "1000.0000"), (67_020_000_600, 20, "5585.0001"), (LONGEST, 1, "15372286728091.2930")])
def test_a_minute_of_any_cpu_time_has_its_share(spark, cpu, vcores, want):
    (row,) = minute_report(facts(spark, [1], cpu_time=str(cpu)), vcores).collect()
    assert str(row.cpu_pct) == want


def test_summaries_of_loads_that_fill_a_minute(spark, database):  # noqa: F811
    name, location = database
    create_tables(spark, name, location=location)
    options = LoadOptions("", "", database=name, location=location)
    for keys in (range(3), range(3, 9)):
        append_batches(facts(spark, keys, cpu_time="6000000000"), name)
        summarize(spark, options)
    (row,) = spark.table(table_name(name, "minute_report")).collect()
    assert (row.execution_count, str(row.cpu_pct)) == (9, "4500.0000")


def test_stored_and_new_rows_travel_once(spark, database, monkeypatch):  # noqa: F811
    name, location = database
    create_tables(spark, name, location=location)
    options = LoadOptions("", "", database=name, location=location)
    shuffles, store = {}, Version.store

    def watched(self, base, df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles[base] = sum(plan.count(f"Exchange {kind}partitioning") for kind in ("hash", "range"))
        return store(self, base, df)

    def dealt(*_):
        raise AssertionError("rows were dealt by range")

    monkeypatch.setattr(Version, "store", watched)
    monkeypatch.setattr(DataFrame, "repartitionByRange", dealt)
    for keys in (range(9), range(9, 20)):
        append_batches(facts(spark, keys), name)
        summarize(spark, options, PlanLimits(group_rows=3))
    found = {base: shuffles[base] for base in ("state_texts", "state_values", "state_minutes", "state_exemplars")}
    assert found == dict.fromkeys(found, 1)
    assert shuffles["state_profiles"] == shuffles["minute_report"] == shuffles["duration_summary"] == 0


@pytest.mark.parametrize("broadcast", [100, 0])
def test_fingerprints_that_become_large(spark, database, broadcast):  # noqa: F811
    name, location = database
    create_tables(spark, name, location=location)
    options = LoadOptions("", "", database=name, location=location)
    texts = ("select {}", "update t set a = {}", "delete from t where a = {}")

    def part(start, sizes):
        rows, at = None, start
        for text, n in zip(texts, sizes):
            some = facts(spark, range(at, at + n), text)
            rows, at = some if rows is None else rows.union(some), at + n
        return rows.withColumn("duration", F.col("event_sequence") * 7 % 5).withColumn("writes", F.when(F.col("event_sequence") % 3 > 0, F.col("writes")))

    whole = None
    for start, sizes, group_rows in ((0, (3, 4, 2), 5), (10, (4, 1, 1), 5), (20, (3, 5, 1), 5), (30, (1, 1, 1), 1000)):
        rows = spark.createDataFrame(part(start, sizes).collect(), BATCHES)
        append_batches(rows, name)
        whole = rows if whole is None else whole.union(rows)
        summarize(spark, options, PlanLimits(group_rows=group_rows, broadcast_fingerprints=broadcast))
        for base, df in derived_by_hand(whole).items():
            stored = spark.table(table_name(name, base)).collect()
            assert sorted(map(str, stored)) == sorted(map(str, df.select(*TABLES[base].fieldNames()).collect())), base
    by_form = [spark.table(table_name(name, f"state_{form}")).select("norm_id").distinct().count() for form in ("profiles", "values")]
    assert by_form == ([1, 2] if broadcast else [0, 3])


def test_a_filter_that_cuts_nothing_is_left_out(spark, tmp_path):
    rows = many_fingerprints(spark, str(tmp_path / "f"))
    first = first_occurrences(rows).localCheckpoint()
    want = sorted(map(str, exemplars_by_aggregate(rows).collect()))
    for log_words, joins in ((3, 0), (20, 2)):
        limits = PlanLimits(broadcast_fingerprints=0, filter_log_words=log_words)
        plan = exemplar_candidates(rows, first, limits)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join LeftSemi") == joins
        found = exemplar_rows(rows, first, limits).select(*TABLES["unique_batches"].fieldNames())
        assert sorted(map(str, found.collect())) == want
