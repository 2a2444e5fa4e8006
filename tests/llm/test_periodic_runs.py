"""Runs against a brute-force search of all lags, and the query's planted texts."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stmtscope.llm import periodic_runs as pr
from stmtscope.llm.queries import op13_periodic_runs


def brute(words):
    """Every maximal stretch of every lag; of one stretch the smallest period."""
    found = {}
    n = len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def check(words):
    assert pr.runs_of(np.array(words, np.int64)) == brute(words)


def test_planted_runs_of_all_periods():
    rng = random.Random(11)
    for _ in range(150):
        n = rng.randint(0, 60)
        words = [rng.randint(0, 400) for _ in range(n)]
        for _ in range(rng.randint(1, 3)):
            q = rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 18, 25, 26, 27, 39, 40, 60, 61, 97, 140])
            period = [rng.randint(0, rng.choice([1, 3, 500])) for _ in range(q)]
            length = rng.randint(2 * q, 4 * q + 30)
            words += (period * (length // q + 1))[:length]
            words += [rng.randint(0, 400) for _ in range(rng.randint(0, 5))]
        check(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=160))
def test_two_words(words):
    check(words)


def test_structured_sequences():
    thue = [bin(i).count("1") % 2 for i in range(2048)]
    check(thue)
    check(thue * 3)
    fib = [0]
    last = [0, 1]
    while len(last) < 1500:
        fib, last = last, last + fib
    check(last)
    check([0] * 500)
    check(([0] * 20 + [1]) * 30)
    check((list(range(50)) + list(range(50))[::-1]) * 4)


def planted(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = brute([number[w] for w in words])
    dropped = set()
    for s, length, q in runs:
        dropped.update(range(s + q, s + length))
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    row = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *row, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(), len(words))


def test_query(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 4000").select("doc_id", "text")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_periodic_runs(spark, str(tmp_path)).collect()
    want = [expected(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(r.n_runs > 0 for r in got) > len(got) / 20


def test_edges(spark, tmp_path, edge_docs, no_docs):
    edge_docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    got = sorted(map(tuple, op13_periodic_runs(spark, f"{tmp_path}/a").collect()), key=str)
    fits = lambda r: r.doc_id != 7  # the long text is too long for brute force
    want = sorted([expected(r.doc_id, r.text) for r in edge_docs.collect() if fits(r)], key=str)
    assert [r for r in got if r[0] != 7] == want
    no_docs.write.parquet(f"{tmp_path}/b/documents.parquet")
    assert op13_periodic_runs(spark, f"{tmp_path}/b").count() == 0


def test_collapsed_text(spark):
    line = "a line that comes again and again "
    docs = spark.createDataFrame([(1, "begin " + line * 5 + "end")], "doc_id long, text string")
    row = pr.find_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(1, 35, 7)]
    assert row.collapsed == "begin a line that comes again and again end"
