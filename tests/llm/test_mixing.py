"""Mixing: weights, budgets to the document, and order, against a plain version."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest

from stmtscope.llm.mixing import mix

SIZES = {"big": 400, "mid": 60, "small": 20, "tiny": 3}


@pytest.fixture(scope="module")
def docs(spark):
    rows, i = [], 0
    for source, n in SIZES.items():
        for _ in range(n):
            rows.append((i, source, 5 + i * 7 % 11, {"k": i}))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long, weight map<string,int>").repartition(3)


def md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def plain(docs, a, tokens):
    """Documents by source in the order of each epoch, up to the source's budget."""
    n_blocks = math.ceil(math.sqrt(len(docs)))
    by_source = defaultdict(list)
    for d, s, n in docs:
        by_source[s].append((d, n, int(md5(d)[:12], 16) % n_blocks))
    total = sum(n for _, _, n in docs)
    taken = Counter()
    for s, own in by_source.items():
        size = sum(n for _, n, _ in own)
        budget = round((size / total) ** a * tokens, 3)
        epochs, rest = int(budget // size), math.floor(budget - budget // size * size)
        for d, n, b in own:
            for e in range(epochs):
                taken[s, d, e] += 1
        own.sort(key=lambda x: (md5(s, x[2], epochs), x[2], md5(x[0], epochs)))
        for d, n, b in own:
            rest -= n
            if rest < 0:
                break
            taken[s, d, epochs] += 1
    return taken


@pytest.mark.parametrize("budget, repeats", [(1.0, 2.0), (None, 3.0), (0.5, 1.0)])
def test_against_plain(docs, budget, repeats):
    rows = [tuple(r)[:3] for r in docs.collect()]
    total = sum(n for _, _, n in rows)
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    p = {s: n / total for s, n in sizes.items()}

    def rate(a):  # tokens per p**a
        return budget * total / sum(x**a for x in p.values()) if budget else max(p.values()) ** (1 - a) * total

    low, high = 0.0, 1.0
    for _ in range(25):
        a = (low + high) / 2
        low, high = (low, a) if max(rate(a) * p[s] ** a / sizes[s] for s in p) <= repeats else (a, high)
    got = mix(docs, budget, repeats).collect()
    assert Counter((r.source, r.doc_id, r.epoch) for r in got) == plain(rows, high, rate(high))
    assert all(isinstance(r.weight, float) for r in got)
    if budget is None:
        assert {r.doc_id for r in got} == {d for d, _, _ in rows}
        assert max(Counter(r.doc_id for r in got).values()) <= math.ceil(repeats)


def test_entropy(docs):
    rows = mix(docs, 1.0, entropy_at_least=1.2).collect()
    weights = {r.source: r.weight for r in rows}
    assert sum(weights.values()) == pytest.approx(1, abs=1e-6)
    assert -sum(w * math.log(w) for w in weights.values()) == pytest.approx(1.2, abs=1e-4)


def test_edge_cases(edge_docs, no_docs):
    got = mix(edge_docs, None, 2.0).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in edge_docs.collect()}
    assert sum(r.doc_id == 1 and r.epoch == 0 for r in got) == 2
    assert mix(no_docs, 1.0).collect() == []
