"""Summaries against brute force, on small groups with NULLs, ties and single rows."""

import random

import pytest
from pyspark.sql import functions as F

from stmtscope.operators import (
    PlanLimits,
    batch_summary,
    duplicate_keys,
    exemplars_by_aggregate,
    metric_summary,
    numbered_executions,
    unique_batches,
    wide_metric_summary,
)
from stmtscope.operators.ranking import dense_ranks_desc, order_bucket
from stmtscope.schema import METRICS, PERCENTILES, wide_metric_summary as wide_schema

COLUMNS = "norm_id long, event_sequence long, " + ", ".join(f"{m} long" for m in METRICS)


def random_groups():
    rng = random.Random(7)
    groups = {1: [7], 2: [None], 3: [None, None], 4: [1, 2], 5: [1, 2, 3], 6: [1, 2, 3, 4]}
    groups[7] = [0] * 50
    groups[8] = [30_000_000] * 40 + list(range(29_999_000, 30_001_000, 7))
    groups[9] = [2**62 - i for i in (1, 5, 9)][:1] + [5]
    groups[10] = [rng.randrange(10**9) for _ in range(500)]
    groups[11] = [123_456_789 + rng.randrange(200) for _ in range(300)]
    groups[12] = [-5, -3, None, 4]
    for k in range(20, 60):
        pool = [rng.randrange(10) for _ in range(4)] + ([None] if k % 2 else [])
        groups[k] = [rng.choice(pool) for _ in range(rng.randrange(1, 13))]
    return groups


GROUPS = random_groups()


def brute_force(values):
    """The rule, row by row: NULLs first, value where row number / n <= p, else 0."""
    ordered = sorted(values, key=lambda v: (v is not None, v or 0))
    known = [v for v in values if v is not None]
    n = len(values)
    low = min(known, default=None)
    total = sum(known) if known else None
    mean = None if total is None else (abs(total) // len(known)) * (1 if total >= 0 else -1)
    out = [low, mean, max(known, default=None), total]
    for percent in PERCENTILES.values():
        if n <= (3 if percent == 25 else 1):
            out.append(low)
            continue
        candidates = [v if (i + 1) * 100 <= percent * n else 0 for i, v in enumerate(ordered)]
        out.append(max((v for v in candidates if v is not None), default=None))
    return tuple(out)


def dense_ranks(totals):
    order = sorted({t for t in totals if t is not None}, reverse=True)
    return {t: order.index(t) + 1 if t is not None else len(order) + 1 for t in totals}


@pytest.fixture(scope="module")
def batches(spark):
    rows, seq = [], 0
    for k, values in GROUPS.items():
        for v in values:
            seq += 1
            other = None if v is None else v % 13
            rows.append((k, seq, v, v, other, other, 0, seq % 5))
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


LIMITS = [
    PlanLimits(),
    PlanLimits(group_rows=0),
    PlanLimits(group_rows=5),
    PlanLimits(group_rows=5, broadcast_fingerprints=1, broadcast_ranks=0, window_fingerprints=0),
]


@pytest.mark.parametrize("limits", LIMITS)
def test_metric_summary(batches, limits):
    got = {
        (r.norm_id, r.metric): r
        for r in metric_summary(batches, ["duration", "logical_reads", "writes"], limits).collect()
    }
    columns = {
        "duration": GROUPS,
        "logical_reads": {k: [None if v is None else v % 13 for v in vs] for k, vs in GROUPS.items()},
        "writes": {k: [0] * len(vs) for k, vs in GROUPS.items()},
    }
    assert len(got) == 3 * len(GROUPS)
    for metric, groups in columns.items():
        want = {k: brute_force(vs) for k, vs in groups.items()}
        ranks = dense_ranks([w[3] for w in want.values()])
        for k, w in want.items():
            r = got[k, metric]
            assert (r.min, r.mean, r.max, r.total, *[r[p] for p in PERCENTILES]) == w, (k, metric)
            assert r.total_rank == ranks[w[3]], (k, metric)


def test_wide_summary_has_table_columns(batches):
    wide = wide_metric_summary(metric_summary(batches, ["duration"]), "duration")
    assert [(f.name, f.dataType) for f in wide.schema] == [
        (f.name, f.dataType) for f in wide_schema("duration")
    ]


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert metric_summary(empty).count() == 0


def test_numbered_executions(batches):
    got = {(r.norm_id, r.event_sequence): r for r in numbered_executions(batches, "duration").collect()}
    rows = {}
    for r in batches.select("norm_id", "event_sequence", "duration").collect():
        rows.setdefault(r.norm_id, []).append((r.duration is not None, r.duration or 0, r.event_sequence))
    assert len(got) == sum(map(len, rows.values()))
    for k, group in rows.items():
        for i, (_, _, seq) in enumerate(sorted(group), 1):
            assert (got[k, seq].execution_number, got[k, seq].execution_count) == (i, len(group))


@pytest.mark.parametrize("broadcast_offsets", [1000, 0])
def test_row_numbers_of_ties(spark, broadcast_offsets):
    from stmtscope.operators.ranking import row_numbers

    rows = spark.createDataFrame([(1, 5, s) for s in range(100)] + [(1, 3, 7_000)], "g long, v long, s long")
    got = row_numbers(rows, "g", "v", "s", "n", "c", broadcast_offsets).collect()
    assert {(r.v, r.s): r.n for r in got} == {(3, 7_000): 1, **{(5, s): s + 2 for s in range(100)}}
    assert {r.c for r in got} == {101}


def test_order_bucket_is_monotone(spark):
    rng = random.Random(3)
    values = {0, 1, 2, 2**53, 2**53 + 1, 2**63 - 1, -(2**63), -1}
    for e in range(1, 63):
        values |= {2**e - 1, 2**e, 2**e + 1, -(2**e), rng.randrange(2**e)}
    rows = spark.createDataFrame([(v,) for v in sorted(values)], "v long")
    buckets = [r.b for r in rows.select("v", order_bucket(F.col("v")).alias("b")).orderBy("v").collect()]
    assert buckets == sorted(buckets)
    assert spark.range(1).select(order_bucket(F.lit(None).cast("long"))).first()[0] is None


def test_dense_ranks(spark):
    values = [5, 5, 9, None, 0, -3, 10**12, 10**12 + 1, None]
    rows = spark.createDataFrame([("a", v) for v in values] + [("b", 1)], "m string, v long")
    got = {(r.m, r.v): r.k for r in dense_ranks_desc(rows, "m", "v", "k").collect()}
    want = {("a", v): k for v, k in dense_ranks(values).items()}
    assert got == {**want, ("b", 1): 1}


@pytest.fixture(scope="module")
def facts(spark):
    rows = [
        (k, s, "sql_batch_completed", f"db{k % 2}", f"t{s % 3}", f"n{k}", s % 3, int(s % 3 == 0), int(s % 3 == 1), 0)
        for s, k in enumerate([1, 2, 1, 1, 3, 2, 1, 9, 1, 1])
    ]
    return spark.createDataFrame(
        rows,
        "norm_id long, event_sequence long, event_type string, database_name string, text_data string, "
        "norm_text string, text_id long, successful int, failed int, aborted int",
    ).repartition(4)


@pytest.mark.parametrize("limits", [PlanLimits(), PlanLimits(broadcast_fingerprints=0)])
def test_unique_batches(facts, limits):
    want = {(1, "db1", "t0", "n1"), (2, "db0", "t1", "n2"), (3, "db1", "t1", "n3"), (9, "db1", "t1", "n9")}
    rows = unique_batches(facts, limits).collect()
    assert {(r.norm_id, r.database_name, r.orig_text, r.norm_text) for r in rows} == want
    assert len(rows) == len(want)
    # Repeated rows and sequences still give one exemplar each, the same one on both ways.
    again = facts.union(facts).withColumn("event_sequence", F.lit(5).cast("long"))
    rows = unique_batches(again, limits).collect()
    assert {(r.norm_id, r.orig_text) for r in rows} == {(1, "t0"), (2, "t1"), (3, "t1"), (9, "t1")}
    assert len(rows) == len(want)


def test_batch_summary(facts):
    got = {r.norm_id: tuple(r)[1:] for r in batch_summary(facts).collect()}
    assert sum(g[0] for g in got.values()) == facts.count()
    for k, g in got.items():
        rows = [r for r in facts.collect() if r.norm_id == k]
        assert g == (
            len(rows),
            len({r.text_id for r in rows}),
            sum(r.successful for r in rows),
            sum(r.failed for r in rows),
            0,
        )


def test_duplicate_keys(spark):
    rows = spark.createDataFrame([(1,), (2,), (2,), (3,), (3,), (3,)], "event_sequence long")
    assert {tuple(r) for r in duplicate_keys(rows).collect()} == {(2, 2), (3, 3)}


def test_percentiles_are_ordered(batches):
    rows = metric_summary(batches.where("norm_id between 7 and 11"), ["duration"]).collect()
    for r in rows:
        steps = [r.min, *[r[p] for p in PERCENTILES], r.max]
        assert steps == sorted(steps), r


def test_large_groups_are_cut_before_the_shuffle(batches, capsys):
    metric_summary(batches, ["duration"], PlanLimits(group_rows=0)).explain()
    plan = capsys.readouterr().out
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan
    assert "Python" not in plan
