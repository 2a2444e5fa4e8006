"""Near duplicates against all pairs of a small table."""

import random

import numpy as np
import pytest

from stmtscope.llm import near_dup
from stmtscope.llm.near_dup import near_duplicates


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def by_all_pairs(rows, k, percent=80):
    sets = [(i, shingle_set(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def made_up(n_groups=6, size=14):
    rng = random.Random(5)
    rows, i = [], 100
    for g in range(n_groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(60 + 40 * g)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randrange(len(base) // 7)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append((i, " ".join(words)))
            i += rng.randrange(1, 4)
    rows += [(i + 1, rows[0][1]), (i + 2, rows[0][1].upper()), (i + 3, "one"), (i + 4, "One"), (i + 5, "one two")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k, members", [(2, 1024), (5, 1024), (2, 3)])
def test_components(spark, monkeypatch, k, members):
    monkeypatch.setattr(near_dup, "BLOCK_MEMBERS", members)
    rows = made_up()
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), shingle=k).collect()
    want = by_all_pairs(rows, k)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({c for _, c in want.values()}) < len(rows)


def test_edge_cases(edge_docs, no_docs):
    got = [tuple(r) for r in near_duplicates(edge_docs, shingle=2).collect()]
    assert len(got) == edge_docs.count()
    assert got.count((1, 10, 1, True)) == 2 and (2, 10, 1, False) in got
    assert {(3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 1, 6, True)} <= set(got)
    assert [r[2:] for r in got if r[0] is None] == [(None, False)]
    assert near_duplicates(no_docs).collect() == []


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(1)
    for n in (0, 5, 400, 5000):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate([a[: n // 2], rng.integers(0, 1 << 63, 30, dtype=np.uint64)])
        cells = int(np.bitwise_count(near_dup.parity(a) ^ near_dup.parity(b)).sum())
        assert cells <= len(set(a.tolist()) ^ set(b.tolist()))


def test_signatures_estimate_similarity(spark):
    words = [f"w{i}" for i in range(900)]
    rows = [(0, " ".join(words[:600])), (1, " ".join(words[100:700]))]
    from pyspark.sql import functions as F

    found = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0L AS text_hash").mapInArrow(near_dup._features(1), near_dup.FEATURES)
    one, two = (found.where(F.col("doc_id") == i).select(F.col("signature").alias(f"s{i}")) for i in (0, 1))
    estimate = near_dup.estimated_similarity(F.col("s0"), F.col("s1"))
    assert abs(one.crossJoin(two).select(estimate.alias("e")).first().e - 500 / 700) < 0.15


def test_one_id_on_different_texts(spark):
    """Rows of one doc_id and different texts are documents of their own; no row and no link is lost."""
    rng = random.Random(9)
    words = [f"w{rng.randrange(10_000)}" for _ in range(200)]
    near = [*words[:100], "other", *words[101:]]
    far = [f"z{i}" for i in range(200)]
    rows = [(1, " ".join(far)), (1, " ".join(words)), (2, " ".join(near)), (3, "alone in the world")]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order * 2, "doc_id long, text string").repartition(3)
        got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame, 2).collect())
        assert got == sorted([(1, 199, 1, True), (1, 199, 1, True), (2, 199, 1, False), (3, 3, 3, True)] * 2)
