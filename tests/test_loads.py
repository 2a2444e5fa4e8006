"""Loads that are written once and published at once, the tables' versions, and their states."""

import gzip
import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stmtscope import operators as ops
from stmtscope.operators.keyfilter import key_filter, log_words_for, might_be_in, word_of
from stmtscope.operators.summaries import exemplar_rows, first_occurrences
from stmtscope.plans import LoadOptions, load, minute_report, summarize
from stmtscope.schema import BATCHES, METRICS
from stmtscope.sources import (
    TABLES,
    DuplicateKeyError,
    Version,
    append_batches,
    clashing_keys,
    create_tables,
    fact_loads,
    loaded_files,
    new_load,
    table_name,
    unpublished_loads,
)
from test_load import event, frame, write_folder


@pytest.fixture()
def database(spark, tmp_path):
    name = f"loads_{tmp_path.name.replace('-', '_')}"
    yield name, str(tmp_path / "db")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def facts(spark, keys, text="select {}", **changes):
    return ops.to_batches(frame(spark, *[event(k, text=text.format(k), **changes) for k in keys]))[0]


def stored_keys(spark, name, suffix=""):
    return sorted(r[0] for r in spark.table(table_name(name, "batches", suffix)).select("event_sequence").collect())


def fact_folder(spark, name, load_id, suffix=""):
    return Path(new_load(spark, name, suffix).base.removeprefix("file:")) / load_id


# --- filters of keys ---


def test_filter_never_misses_and_seldom_errs(spark):
    keys, others = spark.range(20_000), spark.range(20_000, 120_000)
    n = log_words_for(20_000)
    words = key_filter(keys, ["id"], n)
    assert might_be_in(keys, ["id"], words, n).count() == 20_000
    assert might_be_in(others, ["id"], words, n).count() < 0.03 * 100_000


def test_filters_of_one_size_merge_and_larger_ones_split_words(spark):
    both = key_filter(spark.range(100), ["id"], 6)
    parts = key_filter(spark.range(50), ["id"], 6).union(key_filter(spark.range(50, 100), ["id"], 6))
    merged = parts.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    assert sorted(merged.collect()) == sorted(both.collect())
    halves = spark.range(1000).where(F.shiftright(word_of(["id"], 7), 1) != word_of(["id"], 6))
    assert halves.count() == 0


def test_filter_of_no_keys(spark):
    none = spark.range(0)
    words = key_filter(none, ["id"], log_words_for(0))
    assert might_be_in(spark.range(10), ["id"], words, log_words_for(0)).count() == 0


# --- exemplars beyond the broadcast limit ---


def many_fingerprints(spark, folder):
    rows = facts(spark, range(400), text="select a{} from t").withColumn("event_sequence", F.col("event_sequence") % 97)
    rows.union(facts(spark, range(500, 520), text="select 1")).write.parquet(folder)
    return spark.read.schema(BATCHES).parquet(folder)


@pytest.mark.parametrize("log_words", [1, 4, 20])
def test_exemplars_by_filter(spark, tmp_path, log_words):
    rows = many_fingerprints(spark, str(tmp_path / "f"))
    limits = ops.PlanLimits(broadcast_fingerprints=0, filter_log_words=log_words)
    want = sorted(ops.exemplars_by_aggregate(rows).collect())
    assert sorted(ops.unique_batches(rows, limits).collect()) == want and len(want) == 401


def test_exemplars_by_filter_cut_texts_before_any_sort_or_shuffle(spark, tmp_path, capsys):
    rows = many_fingerprints(spark, str(tmp_path / "f"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        first = ops.summaries.checkpointed(first_occurrences(rows))
        exemplar_rows(rows, first, ops.PlanLimits(broadcast_fingerprints=0)).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    plan = capsys.readouterr().out.splitlines()
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "text_data" in line)
    exchange = max(i for i in range(scan) if " Exchange" in plan[i])
    between = "\n".join(plan[exchange + 1 : scan])
    assert "BroadcastHashJoin" in between and "Sort" not in between and "Aggregate" not in between


# --- one write, published at once ---


def test_facts_are_written_once(spark, tmp_path, database):
    name, location = database
    write_folder(tmp_path / "t", {"a.json": [event(i) for i in range(50)] + [event(60, duration="x"), event(61, "attention")]})
    load(spark, LoadOptions(str(tmp_path / "t"), "_x", database=name, location=location))
    found = spark.read.option("recursiveFileLookup", "true").parquet(f"{location}/loads_x/*/rows/kind=fact")
    everywhere = [p for p in Path(location).rglob("*.parquet") if "kind=fact" in str(p)]
    assert found.count() == 50 and len(everywhere) == len(found.inputFiles())
    with_texts = [p for p in Path(location).rglob("*.parquet") if "text_data" in spark.read.parquet(str(p)).columns]
    assert {p.parent.name for p in with_texts} == {"kind=fact", "kind=reject", "kind=filtered"}
    assert stored_keys(spark, name, "_x") == list(range(50))


@pytest.mark.parametrize("step", ["write_rows", "check_load", "publish"])
def test_a_failed_load_leaves_the_table_unchanged(spark, tmp_path, database, monkeypatch, step):
    import importlib

    from stmtscope.sources.loads import Load

    name, location = database
    module = importlib.import_module("stmtscope.plans.load")
    write_folder(tmp_path / "t", {"a.json": [event(1)]})
    write_folder(tmp_path / "u", {"b.json": [event(2)]})
    load(spark, LoadOptions(str(tmp_path / "t"), "", database=name, location=location))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(module if step == "check_load" else Load, step, killed)
        with pytest.raises(KeyboardInterrupt):
            load(spark, LoadOptions(str(tmp_path / "u"), "", database=name, location=location))
    assert stored_keys(spark, name) == [1]
    assert unpublished_loads(new_load(spark, name)) == []
    load(spark, LoadOptions(str(tmp_path / "u"), "", database=name, location=location))
    assert stored_keys(spark, name) == [1, 2]


def test_what_a_killed_driver_leaves_is_unseen_and_listed(spark, database):
    name, location = database
    create_tables(spark, name, location=location)
    append_batches(facts(spark, [1]), name)
    lost = new_load(spark, name)
    lost.write_facts(facts(spark, [2]))
    assert stored_keys(spark, name) == [1]
    assert unpublished_loads(new_load(spark, name)) == [lost.load_id]
    lost.discard()
    assert unpublished_loads(new_load(spark, name)) == []


# --- key check by filters ---


def test_old_keys_are_read_only_in_loads_whose_filter_hits(spark, database):
    name, location = database
    create_tables(spark, name, location=location)
    append_batches(facts(spark, range(0, 300, 3)), name)
    append_batches(facts(spark, range(1, 300, 3)), name)
    first, second = fact_loads(spark, name)
    shutil.rmtree(fact_folder(spark, name, first) / "rows")  # any look at them would fail
    spark.catalog.refreshTable(f"{name}.batches_parts")
    with pytest.raises(DuplicateKeyError, match="100"):
        append_batches(facts(spark, [1000, 100, 1003]), name)
    found = new_load(spark, name)
    found.write_facts(facts(spark, [1000, 100, 7, 1003]))
    assert sorted(map(tuple, clashing_keys(found).collect())) == [(7, second), (100, second)]
    shutil.rmtree(fact_folder(spark, name, second) / "rows")
    append_batches(facts(spark, [2000, 2001]), name)  # no filter hits: nothing old is read
    assert len(fact_loads(spark, name)) == 3


def test_few_hits_reach_the_scan_and_many_are_joined(spark, database, capsys, monkeypatch):
    from stmtscope.sources import loads

    name, location = database
    create_tables(spark, name, location=location)
    append_batches(facts(spark, range(40)), name)
    new = new_load(spark, name)
    new.write_facts(facts(spark, [3, 5, 1000]))
    clashing_keys(new).explain("formatted")
    assert "PushedFilters: [In(event_sequence, [3,5])]" in capsys.readouterr().out
    monkeypatch.setattr(loads, "MAX_INLINE_KEYS", 0)
    assert sorted(r[0] for r in clashing_keys(new).collect()) == [3, 5]


# --- versions ---


def test_a_failure_between_tables_leaves_the_old_version(spark, database, monkeypatch):
    name, location = database
    create_tables(spark, name, location=location)
    options = LoadOptions("", "", database=name, location=location)
    append_batches(facts(spark, range(5)), name)
    summarize(spark, options)
    before = {base: sorted(map(str, spark.table(table_name(name, base)).collect())) for base in TABLES if base != "batches"}
    append_batches(facts(spark, range(5, 9)), name)
    store = Version.store

    def fails_late(self, base, df):
        if base == "writes_summary":
            raise RuntimeError("lost")
        return store(self, base, df)

    with monkeypatch.context() as m:
        m.setattr(Version, "store", fails_late)
        with pytest.raises(RuntimeError):
            summarize(spark, options)
    assert before == {base: sorted(map(str, spark.table(table_name(name, base)).collect())) for base in before}
    summarize(spark, options)
    assert spark.table(table_name(name, "batch_summary")).first().all_executions == 9
    # What the failure left and versions older than the last are gone.
    for base in ("batch_summary", "writes_summary"):
        assert spark.sql(f"SHOW PARTITIONS {name}.{base}_parts").count() == 2


def test_readers_of_the_old_version_go_on(spark, database):
    name, location = database
    create_tables(spark, name, location=location)
    options = LoadOptions("", "", database=name, location=location)
    append_batches(facts(spark, range(5)), name)
    summarize(spark, options)
    begun = spark.table(table_name(name, "batch_summary"))
    assert begun.first().all_executions == 5
    append_batches(facts(spark, range(5, 9)), name)
    summarize(spark, options)
    assert begun.first().all_executions == 5
    assert spark.table(table_name(name, "batch_summary")).first().all_executions == 9


# --- layout ---


def test_filters_read_few_row_groups_of_clustered_facts(spark, database):
    import pyarrow.parquet as pq

    from stmtscope.sources import cluster_facts

    name, location = database
    create_tables(spark, name, location=location)
    n = 24_000
    base = facts(spark, [0])
    rows = base.drop("event_sequence", "event_ts", "norm_id").crossJoin(F.broadcast(spark.range(n))).select(
        F.col("id").alias("event_sequence"),
        (F.timestamp_seconds(F.lit(1_700_000_000)) + F.make_dt_interval(mins=(F.col("id") % 7200).cast("int"))).alias("event_ts"),
        F.shiftright(F.xxhash64(F.col("id") % 500), 4).bitwiseAND(F.lit((1 << 60) - 1)).alias("norm_id"),
        *[c for c in base.columns if c not in ("event_sequence", "event_ts", "norm_id")],
    )
    append_batches(rows, name)
    (load_id,) = fact_loads(spark, name)
    cluster_facts(spark, name, files=8, write_options={"maxRecordsPerFile": "8"})
    stored = spark.table(table_name(name, "batches"))
    assert stored.count() == n and stored.select("event_sequence").distinct().count() == n
    groups = []
    for file in fact_folder(spark, name, load_id).glob("clustered-*/*.parquet"):
        about = pq.ParquetFile(file).metadata
        for i in range(about.num_row_groups):
            columns = {about.row_group(i).column(j).path_in_schema: about.row_group(i).column(j) for j in range(about.num_columns)}
            groups.append((columns["norm_id"].statistics, pq.read_table(file, columns=["event_ts"]).column(0).to_pylist()))
    assert len(groups) >= 3000
    wanted = stored.select("norm_id", "event_ts").where("event_sequence = 777").first()
    by_id = sum(s.min <= wanted.norm_id <= s.max for s, _ in groups)
    hour = wanted.event_ts.replace(minute=0, second=0)
    by_hour = sum(min(ts).replace(tzinfo=None) <= hour.replace(minute=59) and max(ts).replace(tzinfo=None) >= hour for _, ts in groups)
    assert by_id < 0.05 * len(groups) and by_hour < 0.05 * len(groups)
    # The load is still a load: its keys are known, and its states follow.
    with pytest.raises(DuplicateKeyError):
        append_batches(facts(spark, [5]), name)


# --- states ---


def derived_by_hand(batches):
    summary = ops.metric_summary(batches)
    return {
        "unique_batches": ops.unique_batches(batches),
        "batch_summary": ops.batch_summary(batches),
        **{f"{m}_summary": ops.wide_metric_summary(summary, m) for m in METRICS},
        "minute_report": minute_report(batches),
    }


@pytest.mark.parametrize("limits", [ops.PlanLimits(), ops.PlanLimits(group_rows=3, broadcast_fingerprints=1, window_fingerprints=1)])
def test_summaries_of_added_loads(spark, database, limits):
    name, location = database
    create_tables(spark, name, location=location)
    options = LoadOptions("", "", database=name, location=location)
    parts = [
        facts(spark, range(30)).withColumn("duration", F.col("event_sequence") * 7 % 11),
        facts(spark, range(30, 50), text="update t{} set a = 1").withColumn("writes", F.lit(None).cast("long")),
        facts(spark, range(50, 80)).withColumn("norm_text", F.col("norm_text")),
    ]
    whole = None
    for part in parts:
        append_batches(part, name)
        part = spark.createDataFrame(part.collect(), BATCHES)
        whole = part if whole is None else whole.union(part)
        summarize(spark, options, limits)
        for base, df in derived_by_hand(whole).items():
            stored = spark.table(table_name(name, base)).collect()
            assert sorted(map(str, stored)) == sorted(map(str, df.select(*TABLES[base].fieldNames()).collect())), base
        # Later summaries cannot look at these facts again.
        shutil.rmtree(fact_folder(spark, name, fact_loads(spark, name)[-1]) / "rows")
        spark.catalog.refreshTable(f"{name}.batches_parts")


def test_a_load_that_was_taken_away_is_forgotten(spark, database):
    name, location = database
    create_tables(spark, name, location=location)
    options = LoadOptions("", "", database=name, location=location)
    append_batches(facts(spark, range(5)), name)
    append_batches(facts(spark, range(5, 9)), name)
    summarize(spark, options)
    spark.sql(f"ALTER TABLE {name}.batches_parts DROP PARTITION (load_id = '{fact_loads(spark, name)[0]}')")
    summarize(spark, options)
    assert spark.table(table_name(name, "batch_summary")).first().all_executions == 4


def test_summary_of_an_empty_table(spark, database):
    name, location = database
    create_tables(spark, name, location=location)
    summarize(spark, LoadOptions("", "", database=name, location=location))
    assert all(spark.table(table_name(name, base)).count() == 0 for base in TABLES)


# --- files ---


def known_files(spark, name):
    return sorted((r.file_name, r.events_read, r.problem is None) for r in loaded_files(new_load(spark, name)).collect())


def test_each_file_is_loaded_once(spark, tmp_path, database):
    name, location = database
    folder = tmp_path / "t [x]"  # with characters of patterns
    write_folder(folder, {"a.json": [event(1), event(2)], "b{1} x%20+y.json": [event(3)]})
    options = LoadOptions(str(folder).replace("[", "\\[").replace("]", "\\]"), "", database=name, location=location, only_new_files=True)
    load(spark, options)
    (folder / "c.json").write_text(json.dumps(event(4)) + "\n")
    (folder / "empty.json").write_text("")
    stats, _ = load(spark, options)
    assert sorted((r.file_name, r.events_kept) for r in stats.collect()) == [("c.json", 1), ("empty.json", 0)]
    stats, rejects = load(spark, options)
    assert rejects.count() == 0 and stored_keys(spark, name) == [1, 2, 3, 4]
    # A file that has changed is no longer the one that was loaded; its old events are refused.
    (folder / "c.json").write_text(json.dumps(event(4)) + "\n" + json.dumps(event(5)) + "\n")
    with pytest.raises(DuplicateKeyError):
        load(spark, options)
    assert stored_keys(spark, name) == [1, 2, 3, 4]


def test_damaged_files_are_set_aside_and_tried_again(spark, tmp_path, database):
    name, location = database
    folder = tmp_path / "t"
    write_folder(folder, {f"f{i}.json": [event(10 * i + j) for j in range(4)] for i in range(5)})
    whole = gzip.compress("".join(json.dumps(event(100 + j, text="x" * 3000 + str(j))) + "\n" for j in range(300)).encode())
    (folder / "cut.json.gz").write_bytes(whole[: len(whole) // 2])
    (folder / "none.json.gz").write_bytes(b"not compressed\n")
    strict = LoadOptions(str(folder), "", database=name, location=location)
    with pytest.raises(Exception):
        load(spark, strict)
    assert stored_keys(spark, name) == []
    options = LoadOptions(str(folder), "", database=name, location=location, skip_damaged_files=True, only_new_files=True)
    stats, rejects = load(spark, options)
    assert sorted((r.file_name, r.reject_reason) for r in rejects.collect()) == [
        ("cut.json.gz", "unreadable file"), ("none.json.gz", "unreadable file"),
    ]
    assert {r.file_name: r.events_kept for r in stats.collect()}["cut.json.gz"] == 0
    problems = {r.file_name: r.problem for r in loaded_files(new_load(spark, name)).collect() if r.problem}
    assert set(problems) == {"cut.json.gz", "none.json.gz"} and all(problems.values())
    assert len(stored_keys(spark, name)) == 20
    (folder / "cut.json.gz").write_bytes(whole)
    (folder / "none.json.gz").write_bytes(gzip.compress(b""))
    load(spark, options)
    assert len(stored_keys(spark, name)) == 320


def test_damaged_parquet_footer(spark, tmp_path, database):
    name, location = database
    folder = tmp_path / "t"
    frame(spark, *[event(i) for i in range(30)]).repartition(3).write.parquet(str(folder))
    files = sorted(folder.glob("*.parquet"))
    damaged = files[1].read_bytes()
    files[1].write_bytes(damaged[: len(damaged) - 20] + b"\0" * 20)
    (folder / f".{files[1].name}.crc").unlink()
    options = LoadOptions(str(folder), "", database=name, location=location, pattern="*.parquet", fmt="parquet", skip_damaged_files=True)
    _, rejects = load(spark, options)
    assert [(r.file_name, r.reject_reason) for r in rejects.collect()] == [(files[1].name, "unreadable file")]
    assert 0 < len(stored_keys(spark, name)) < 30
