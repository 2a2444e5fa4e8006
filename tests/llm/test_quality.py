"""Quality rules against a plain version; the classifier's accuracy on labels it never saw."""

import math
import random
import re
import zlib
from collections import Counter

from stmtscope.llm import quality_rules as rules
from stmtscope.llm.quality_vote import quality_scores


def base_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def prose(rng, n=80):
    return " ".join(rng.choice("the river ran past old mills where people met and talked about rain".split()) + rng.choice(["", "", ",", "."]) for _ in range(n))


def junk(rng, n=80):
    return " ".join(w.strip(",.").upper() + "!!" for w in prose(rng, n).split())


def test_rules(spark, edge_docs):
    rng = random.Random(8)
    texts = [prose(rng) for _ in range(60)] + [junk(rng) for _ in range(20)]
    texts += ["a b c d e f a b c d e x y z a b c d e", "one line here\none line here\n \n\nother # line * with $5 & <b>", "x " * 400]
    rows = [(i + 10, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(edge_docs.select("doc_id", "text"))
    trusted = spark.createDataFrame([(i,) for i in range(10, 60)] + [(None,), (10,)], "doc_id long")
    got = rules.quality_rules(docs, trusted).collect()
    measures = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
    want = Counter((r.doc_id, *base_measures(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, *measures(r)) for r in got) == want
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].kept for i in range(10, 70)) and not any(by_id[i].kept for i in range(70, 90))


def test_log_ratio(spark):
    texts = {1: "Aa bb bb", 2: "bb CC", 3: "zz"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.score for r in rules.quality_rules(docs, docs.where("doc_id = 1").select("doc_id")).collect()}
    shape = lambda w: re.sub("[0-9]+", "0", re.sub("[A-Z]+", "A", re.sub("[a-z]+", "a", w)))

    def grams(t):
        words = t.split()
        return [*words, *zip(map(shape, words), map(shape, words[1:]))]

    corpus, target = Counter(g for t in texts.values() for g in grams(t)), Counter(grams(texts[1]))
    s, n = rules.SMOOTHING, rules.SMOOTHING * rules.SLOTS
    for i, t in texts.items():
        logs = [
            math.log((target[g] + s) / (target.total() + n)) - math.log((corpus[g] + s) / (corpus.total() + n)) for g in grams(t)
        ]
        assert abs(got[i] - sum(logs) / len(logs)) < 1e-9


def test_rules_of_nothing(spark, no_docs):
    assert rules.quality_rules(no_docs, spark.createDataFrame([], "doc_id long")).collect() == []


def test_classifier(spark, edge_docs):
    rng = random.Random(9)
    texts = [(i, prose(rng) if i % 5 else junk(rng), int(i % 5 > 0)) for i in range(100, 600)]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string").unionByName(edge_docs.select("doc_id", "text"))
    labels = spark.createDataFrame(
        [(i, q, 0) for i, _, q in texts if i % 2] + [(None, 1, 0), (101, None, 0)], "doc_id long, quality int, toxic int"
    )
    got = quality_scores(docs, labels).collect()
    assert len(got) == docs.count()
    want = {i: q for i, _, q in texts}
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert sum(r.predicted == want[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_classifier_without_labels(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_scores(edge_docs, labels).collect()} == {0.5}
    assert quality_scores(no_docs, labels).collect() == []
