"""Key checks whose cost grows no faster than the keys."""

import pytest
from pyspark.sql import functions as F

from stmtscope.operators.keyfilter import counted_filter, found_in_filters, key_filter
from stmtscope.sources import DuplicateKeyError, append_batches, clashing_keys, create_tables, fact_loads, loads, new_load
from test_loads import database, facts, stored_keys  # noqa: F401  (database is a fixture)


@pytest.fixture()
def nothing_is_small(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


def plan_of(df, capsys):
    df.explain()
    return capsys.readouterr().out


# --- keys ---


def test_one_shuffle_of_the_keys_gives_filter_and_counts(spark, tmp_path, nothing_is_small, capsys):
    folder = str(tmp_path / "keys")
    spark.range(1000).union(spark.range(990, 1000)).write.parquet(folder)
    keys = spark.read.parquet(folder)
    words = counted_filter(keys, ["id"], 8)
    exchanges = [line for line in plan_of(words, capsys).splitlines() if " Exchange" in line]
    assert len(exchanges) == 1
    assert sorted(words.select("word", "bits").collect()) == sorted(key_filter(keys, ["id"], 8).collect())
    # Words that hold a repeated key, and no others, say so.
    repeated = key_filter(spark.range(990, 1000), ["id"], 8).select("word")
    assert sorted(words.where("most > 1").select("word").collect()) == sorted(repeated.collect())


def test_repeated_keys_are_looked_for_only_where_the_counts_say_so(spark, database, monkeypatch):  # noqa: F811
    name, location = database
    create_tables(spark, name, location=location)
    with pytest.raises(DuplicateKeyError, match="example 7"):
        append_batches(facts(spark, [5, 6, 7]).union(facts(spark, [7], text="select b{}")), name)

    def grouped(*_):
        raise AssertionError("keys were grouped again")

    monkeypatch.setattr(loads, "duplicate_keys", grouped)
    append_batches(facts(spark, [5, 6, 7]), name)
    assert stored_keys(spark, name) == [5, 6, 7]


def test_a_filter_belongs_to_the_rows_that_are_written(spark, database):  # noqa: F811
    from stmtscope.operators.flatten import flatten_all
    from test_load import event, frame

    name, location = database
    create_tables(spark, name, location=location)
    new = new_load(spark, name)
    new.write_rows(flatten_all(frame(spark, event(1), event(2))))
    new.write_filter()
    new.write_rows(flatten_all(frame(spark, event(3))))
    new.publish()
    with pytest.raises(DuplicateKeyError, match="example 3"):
        append_batches(facts(spark, [3]), name)
    append_batches(facts(spark, [1]), name)
    assert stored_keys(spark, name) == [1, 3]


@pytest.mark.parametrize("sizes", [[6], [4, 6]])
def test_keys_are_found_in_filters_of_any_sizes(spark, nothing_is_small, capsys, sizes):
    filters = None
    for n in sizes:
        words = key_filter(spark.range(50 * n, 50 * n + 40), ["id"], n).withColumns({"of": F.lit(f"f{n}"), "log_words": F.lit(n)})
        filters = words if filters is None else filters.unionByName(words)
    found = found_in_filters(spark.range(1000), ["id"], filters, sizes)
    pairs = {tuple(r) for r in found.collect()}
    for n in sizes:
        assert {(k, f"f{n}") for k in range(50 * n, 50 * n + 40)} <= pairs
    assert len(pairs) < 300
    # Rows are ordered by the word, which tells them apart, and only keys are shuffled.
    join = next(line for line in plan_of(found, capsys).splitlines() if "SortMergeJoin" in line)
    assert "[shiftrightunsigned" in join and join.index("word#") < join.index("Inner")


def test_old_keys_are_cut_in_place(spark, database, nothing_is_small, capsys, monkeypatch):  # noqa: F811
    name, location = database
    create_tables(spark, name, location=location)
    append_batches(facts(spark, range(60)), name)
    append_batches(facts(spark, range(60, 90)), name)
    new = new_load(spark, name)
    new.write_facts(facts(spark, [3, 5, 70, 1000]))
    monkeypatch.setattr(loads, "MAX_INLINE_KEYS", 0)
    found = clashing_keys(new)
    first, second = fact_loads(spark, name)
    assert sorted(map(tuple, found.collect())) == [(3, first), (5, first), (70, second)]
    plan = plan_of(found, capsys).splitlines()
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "batches_parts" in line)
    exchange = max(i for i in range(scan) if " Exchange" in plan[i] and "hashpartitioning(event_sequence" in plan[i])
    assert any("BroadcastHashJoin" in line and "LeftSemi" in line for line in plan[exchange:scan])


def test_a_first_load_looks_up_nothing(spark, database, monkeypatch):  # noqa: F811
    name, location = database
    create_tables(spark, name, location=location)
    new = new_load(spark, name)
    new.write_facts(facts(spark, [1, 2]))
    monkeypatch.setattr(type(spark), "createDataFrame", None)  # no Python rows for an empty answer
    assert clashing_keys(new).columns == ["event_sequence", "load_id"] and clashing_keys(new).isEmpty()
