"""Source, filters, flattening, sinks and the two jobs, from event files to reports."""

import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stmtscope.functions import to_instant
from stmtscope.operators import (
    drop_connection_resets,
    flatten_events,
    keep_event_types,
    outcome_flags,
    to_batches,
    with_norm_texts,
    within_time_range,
)
from stmtscope.operators import filters as filter_module
from stmtscope.plans import LoadOptions, load, minute_report, report, series, summarize
from stmtscope.schema import BATCHES, EVENT, METRICS
from stmtscope.sources import (
    TABLES,
    DuplicateKeyError,
    append_batches,
    create_tables,
    read_events,
    table_name,
    write_tables,
)

METRIC_VALUES = {m: str(10 * (i + 1)) for i, m in enumerate(METRICS)}


def event(seq, name="sql_batch_completed", ts="2024-01-05T10:00:00Z", text="select 1", drop=(), **changes):
    fields = {"result": "OK", **METRIC_VALUES}
    if name == "rpc_completed":
        fields |= {"object_name": "MyProc", "statement": "exec dbo.MyProc @a=1"}
    else:
        fields["batch_text"] = text
    actions = {
        "event_sequence": str(seq),
        "client_pid": "5",
        "client_hostname": "h",
        "client_app_name": "app",
        "database_name": "db",
        "username": "u",
    }
    for key, value in changes.items():
        (actions if key in actions else fields)[key] = value
    for key in drop:
        fields.pop(key, None)
        actions.pop(key, None)
    return {"name": name, "event_ts": ts, "fields": fields, "actions": actions}


def frame(spark, *events):
    rows = [
        (e["name"], e["event_ts"] and datetime.fromisoformat(e["event_ts"]), e["fields"], e["actions"])
        for e in events
    ]
    return spark.createDataFrame(rows, EVENT)


def sequences(df):
    return sorted(int(r.actions["event_sequence"]) for r in df.collect())


def test_event_type_filter(spark):
    events = frame(spark, event(1), event(2, "rpc_completed"), event(3, "attention"))
    assert sequences(keep_event_types(events)) == [1, 2]
    assert sequences(keep_event_types(events, ["attention"])) == [3]


def test_connection_reset_filter(spark):
    events = frame(
        spark,
        event(1, "rpc_completed", object_name="sp_reset_connection"),
        event(2, "rpc_completed", object_name=None),
        event(3, "rpc_completed", drop=["object_name"]),
        event(4, text="exec sp_reset_connection"),
        event(5, object_name="sp_reset_connection"),
        event(6, "rpc_completed", object_name="SP_RESET_CONNECTION"),
    )
    assert sequences(drop_connection_resets(events)) == [2, 3, 4, 5, 6]


def test_time_range_is_inclusive(spark):
    events = frame(
        spark,
        event(1, ts="2024-01-05T04:59:59.999999Z"),
        event(2, ts="2024-01-05T05:00:00Z"),
        event(3, ts="2024-01-05T06:00:00Z"),
        event(4, ts="2024-01-05T06:00:00.000001Z"),
    )
    kept = within_time_range(events, "2024-01-05 01:30:00", "2024-01-05 02:30:00", "-03:30")
    assert sequences(kept) == [2, 3]
    assert sequences(within_time_range(events, end_time="2024-01-05 10:30", tz_offset="+05:30")) == [1, 2]
    assert sequences(within_time_range(events)) == [1, 2, 3, 4]


def test_filters_reach_the_file_scan(spark, tmp_path, capsys):
    folder = str(tmp_path / "events")
    frame(spark, event(1)).write.parquet(folder)
    kept = within_time_range(keep_event_types(read_events(spark, folder, fmt="parquet")), "2024-01-01")
    kept.explain("formatted")
    pushed = next(line for line in capsys.readouterr().out.splitlines() if "PushedFilters" in line)
    assert "In(name" in pushed and "GreaterThanOrEqual(event_ts" in pushed


@pytest.mark.parametrize(
    "value, offset, day_first, want",
    [
        ("2024-03-04 05:06:07", "+00:00", None, "2024-03-04T05:06:07"),
        ("2024-03-04 05:06:07", "-03:30", None, "2024-03-04T08:36:07"),
        ("2024-03-04", "+05:30", None, "2024-03-03T18:30:00"),
        ("04/03/2024 05:06:07", "+00:00", True, "2024-03-04T05:06:07"),
        ("03/04/2024 05:06", "+00:00", False, "2024-03-04T05:06:00"),
        (datetime(2024, 3, 4, 5), "+01:00", None, "2024-03-04T04:00:00"),
        (datetime(2024, 3, 4, 5, tzinfo=timezone.utc), "+01:00", None, "2024-03-04T05:00:00"),
    ],
)
def test_bounds(value, offset, day_first, want):
    assert to_instant(value, offset, day_first) == datetime.fromisoformat(want).replace(tzinfo=timezone.utc)


@pytest.mark.parametrize(
    "value, offset", [("nonsense", "+00:00"), ("01/02/2024", "+00:00"), ("2024-01-01", "3"), ("2024-01-01", "+01:75")]
)
def test_malformed_bounds_raise(value, offset):
    with pytest.raises(ValueError):
        to_instant(value, offset)


def test_outcome_flags(spark):
    rows = spark.createDataFrame([("OK",), ("Error",), ("Abort",), ("ok",), (None,)], "r string")
    flags = outcome_flags(F.col("r"))
    got = rows.select(*[c.alias(n) for n, c in flags.items()]).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0), (0, 0, 0)]


def test_flatten(spark):
    events = frame(
        spark,
        event(1, text="select  'x', 5"),
        event(2, "rpc_completed", drop=["username"], result="Abort"),
        event(3, text=None),
    )
    good, rejects = to_batches(events)
    rows = {r.event_sequence: r for r in good.collect()}
    assert good.columns == BATCHES.fieldNames()
    assert [f.dataType for f in good.schema] == [f.dataType for f in BATCHES]
    assert rejects.count() == 0
    assert (rows[1].norm_text, rows[1].text_data) == ("select {STR}, {##}", "select  'x', 5")
    assert (rows[1].client_pid, rows[1].username, rows[1].successful) == (5, "u", 1)
    assert (rows[2].norm_text, rows[2].text_data) == ("MyProc", "exec dbo.MyProc @a=1")
    assert (rows[2].username, rows[2].aborted) == (None, 1)
    assert (rows[3].norm_text, rows[3].text_data) == ("", "")
    assert [rows[1][m] for m in METRICS] == [int(v) for v in METRIC_VALUES.values()]
    captured, _ = to_batches(events, capture_schema_name=True)
    assert {r.norm_text for r in captured.collect()} == {"select {STR}, {##}", "dbo.MyProc", ""}


def test_rejects(spark):
    bad = {
        "missing event_ts": event(0, ts=None),
        "missing event_sequence": event(1, drop=["event_sequence"]),
        "invalid event_sequence": event("x"),
        "missing client_pid": event(2, drop=["client_pid"]),
        "invalid client_pid": event(3, client_pid="99999999999"),
        "missing database_name": event(4, drop=["database_name"]),
        "missing client_hostname": event(5, client_hostname=None),
        "missing object_name": event(6, "rpc_completed", drop=["object_name"]),
        "missing statement": event(7, "rpc_completed", drop=["statement"]),
        "missing batch_text": event(8, drop=["batch_text"]),
        "missing result": event(9, drop=["result"]),
        "missing duration": event(10, duration=None),
        "invalid cpu_time": event(11, cpu_time="1.5"),
        "invalid writes": event(12, writes="-1"),
        "invalid row_count": event(13, row_count=str(2**63)),
    }
    good, rejects = to_batches(frame(spark, event(99), *bad.values()))
    assert [r.event_sequence for r in good.collect()] == [99]
    assert sorted(r.reject_reason for r in rejects.collect()) == sorted(bad)


def test_flatten_needs_no_shuffle_and_no_python(spark, capsys):
    flatten_events(frame(spark, event(1))).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("inline", [200, 1])
def test_norm_text_subset(spark, monkeypatch, inline):
    monkeypatch.setattr(filter_module, "MAX_INLINE_VALUES", inline)
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "norm_text string")
    assert sorted(r[0] for r in with_norm_texts(rows, ["a", "c", "a", "x"]).collect()) == ["a", "c"]
    assert with_norm_texts(rows, None).count() == 3


@pytest.mark.parametrize("cpu, vcores, want", [(1_200_000_000, 20, "100.0000"), (600, 20, "0.0001"), (599, 20, "0.0000"), (1234567, 3, "0.6859")])
def test_cpu_percent_rounds_half_up(spark, cpu, vcores, want):
    good, _ = to_batches(frame(spark, event(1, cpu_time=str(cpu)), event(2, ts="2024-01-05T10:01:00Z", cpu_time="0")))
    rows = minute_report(good, vcores).orderBy("minute").collect()
    assert [str(r.cpu_pct) for r in rows] == [want, "0.0000"]
    assert rows[0].minute == datetime(2024, 1, 5, 10) and rows[0].avg_row_count == 60


def write_folder(path, files):
    path.mkdir()
    for name, events in files.items():
        (path / name).write_text("".join(json.dumps(e) + "\n" for e in events))


@pytest.fixture()
def database(spark, tmp_path):
    name = f"load_{tmp_path.name.replace('-', '_')}"
    yield name, str(tmp_path / "db")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_load_and_summarize(spark, tmp_path, database):
    name, location = database
    folder = tmp_path / "traces"
    write_folder(
        folder,
        {
            "a1.json": [event(i, text=f"select {i}", duration=str(1_000_000 * i)) for i in range(1, 6)]
            + [event(50, "attention"), event(51, "rpc_completed", object_name="sp_reset_connection")],
            "a2.json": [event(10, "rpc_completed"), event(11, duration="bad"), event(12, ts="2023-01-01T00:00:00Z")],
            "notes.txt": [{"name": "not an event"}],
        },
    )
    (folder / "deeper").mkdir()
    (folder / "deeper" / "a3.json").write_text(json.dumps(event(77)))
    options = LoadOptions(
        path=str(folder),
        pattern="*.json",
        suffix="_jan",
        database=name,
        location=location,
        start_time="01/01/2024",
        day_first=True,
        filter_connection_resets=True,
    )
    stats, rejects = load(spark, options)
    assert {tuple(r) for r in stats.collect()} == {("a1.json", 7, 5, 0, 2), ("a2.json", 3, 1, 1, 1)}
    assert [(r.event_sequence, r.file_name, r.reject_reason) for r in rejects.collect()] == [
        (11, "a2.json", "invalid duration")
    ]
    facts = spark.table(table_name(name, "batches", "_jan"))
    assert sorted(r.event_sequence for r in facts.collect()) == [1, 2, 3, 4, 5, 10]

    for buckets in (None, 2):
        options.buckets = buckets
        summarize(spark, options)
        for base, columns in TABLES.items():
            stored = spark.table(table_name(name, base, "_jan"))
            assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in columns]
        ranked = report(spark, name, "_jan", "duration").collect()
        assert [(r.norm_text, r.all_executions, r.total_duration_seconds) for r in ranked] == [
            ("select {##}", 5, 15),
            ("MyProc", 1, 0),
        ]
        assert ranked[0].median_duration == 2_000_000
        assert len(report(spark, name, "_jan", "duration", top_k=1).collect()) == 1
        only = report(spark, name, "_jan", "cpu_time", norm_texts=["MyProc"]).collect()
        assert [r.norm_text for r in only] == ["MyProc"]
        lines = series(spark, name, "_jan").collect()
        assert sorted((r.norm_text, r.execution_count) for r in lines) == [("MyProc", 1), ("select {##}", 5)]

    # The same events again break the key; nothing is added.
    with pytest.raises(DuplicateKeyError):
        load(spark, options)
    assert spark.table(table_name(name, "batches", "_jan")).count() == 6


def test_reports_join_bucketed_tables_without_shuffle(spark, tmp_path, database, capsys):
    name, location = database
    create_tables(spark, name, location=location)
    rows = [(k, k, 1, 1, 0, 0) for k in range(20)]
    counts = spark.createDataFrame(rows, TABLES["batch_summary"])
    texts = spark.createDataFrame([(k, "e", "d", "t", "n") for k in range(20)], TABLES["unique_batches"])
    write_tables({"batch_summary": counts, "unique_batches": texts}, name, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(f"{name}.batch_summary").join(spark.table(f"{name}.unique_batches"), "norm_id")
        assert joined.count() == 20
        joined.explain()
        assert "Exchange" not in capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_append_checks_keys_and_goes_by_name(spark, tmp_path, database):
    name, location = database
    create_tables(spark, name, location=location)
    good, _ = to_batches(frame(spark, event(1), event(2)))
    append_batches(good.select(*reversed(good.columns)), name)
    more, _ = to_batches(frame(spark, event(3), event(3)))
    with pytest.raises(DuplicateKeyError, match="3"):
        append_batches(more, name)
    clash, _ = to_batches(frame(spark, event(2), event(4)))
    with pytest.raises(DuplicateKeyError, match="2"):
        append_batches(clash, name)
    fresh, _ = to_batches(frame(spark, event(4)))
    append_batches(fresh, name)
    stored = spark.table(table_name(name, "batches"))
    assert sorted(r.event_sequence for r in stored.collect()) == [1, 2, 4]
    assert {r.database_name for r in stored.collect()} == {"db"}


def test_unreadable_lines_become_rejects(spark, tmp_path):
    folder = tmp_path / "broken"
    folder.mkdir()
    (folder / "x.json").write_text(json.dumps(event(1)) + "\n{not json\n")
    (folder / "empty.json").write_text("")
    (folder / "y.json").write_text(json.dumps({**event(2), "event_ts": "soon"}) + "\n")
    good, rejects = to_batches(read_events(spark, str(folder)))
    assert [r.event_sequence for r in good.collect()] == [1]
    found = {(r.file_name, r.raw_line, r.reject_reason) for r in rejects.collect()}
    assert found == {("x.json", "{not json", "unreadable line"), ("y.json", None, "invalid event_ts")}
    options = LoadOptions(str(folder), "_lost", database="lost", location=str(tmp_path / "lost"))
    stats, rejects = load(spark, options)
    assert {tuple(r) for r in stats.collect()} == {("x.json", 2, 1, 1, 0), ("y.json", 1, 0, 1, 0), ("empty.json", 0, 0, 0, 0)}
    assert rejects.count() == 2


def test_ids_do_not_depend_on_partitions(spark):
    events = frame(spark, *[event(i, text=f"select {i}, 'x'") for i in range(20)])
    one = {r.norm_id for r in to_batches(events.coalesce(1))[0].collect()}
    many = {r.norm_id for r in to_batches(events.repartition(5))[0].collect()}
    assert one == many and len(one) == 1


def test_load_leaves_no_staging_behind(spark, tmp_path):
    from stmtscope.operators.staging import shared_folder

    folder = tmp_path / "traces"
    folder.mkdir()
    (folder / "x.json").write_text(json.dumps(event(1)) + "\n")
    options = LoadOptions(str(folder), "_clean", database="clean", location=str(tmp_path / "clean"))
    staged = lambda: {p.name for p in Path(shared_folder(spark)).glob("stmtscope-*")}
    before = staged()
    load(spark, options)
    assert staged() == before
    with pytest.raises(DuplicateKeyError):
        load(spark, options)
    assert staged() == before
