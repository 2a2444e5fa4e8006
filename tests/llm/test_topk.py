"""Exact top-k against plain products."""

import numpy as np
import pytest

from stmtscope.llm import topk
from stmtscope.llm.topk import Block, add_slices, top_k


@pytest.mark.parametrize("block_rows", [64, 100_000])
def test_against_products(spark, monkeypatch, block_rows):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 7)).astype(np.float32)
    x[50:120] = x[3]  # many ties
    rows = [(int(i), v.tolist(), "q") for i, v in enumerate(x)]
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>, q string").repartition(3), k=20).collect()
    v = np.floor(x.astype(float) * 64).astype(int)
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(by_query) == list(range(0, 300, 20))
    for q, found in by_query.items():
        scores = v @ v[q]
        order = [i for i in np.lexsort((np.arange(300), -scores)) if i != q][:20]
        assert sorted(found) == [(n + 1, i, int(scores[i])) for n, i in enumerate(order)]


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [1.0, -inf]), (None, [1.0, 1.0]), (6, []), (7, [-1.5, 0.5]), (20, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in top_k(vectors, k=2).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 64 * 64), (0, 2, 6, 0)]
    assert top_k(vectors.where("false")).collect() == []
    same = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (1, [1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in top_k(same).collect()] == [(0, 1, 1, 4096)]


@pytest.mark.parametrize("block_rows", [16, 100_000])
def test_scores_beyond_64_bits(spark, monkeypatch, block_rows):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(4)
    v = rng.integers(-(1 << 45), 1 << 45, (60, 5))
    v[7] = v[0]
    v[30:50] >>= 36  # some scores that fit
    rows = [(int(i), (x / 64).tolist()) for i, x in enumerate(v)]
    rows += [(100, [2.0**33]), (101, [2.0**60, 1.0])]  # the last is too large
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), k=61).collect()
    vectors = {i: [int(c) for c in x] for i, x in enumerate(v)} | {100: [1 << 39]}
    clipped = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    for q in (0, 20, 40, 100):
        scores = {i: sum(a * b for a, b in zip(vectors[q], x)) for i, x in vectors.items() if i != q}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        found = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert found == [(n + 1, i, clipped(scores[i])) for n, i in enumerate(order)]
    two = spark.createDataFrame([(0, [2.0**33]), (1, [2.0**33])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in top_k(two).collect()] == [(0, 1, 1, (1 << 63) - 1)]


def test_bitmap_sums():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 100, (130, 5))
    block = Block(np.arange(130), values)
    ids, scores = block.search(-1, np.array([3, -2, 0, 7, -1]), 130)
    assert sorted(zip(ids, scores)) == [(i, s) for i, s in enumerate(values @ [3, -2, 0, 7, -1])]
    planes = add_slices({0: [np.array([[3], [1], [1]], np.uint64)]}, 1)
    assert [int(p[0]) for p in planes] == [3, 1]
