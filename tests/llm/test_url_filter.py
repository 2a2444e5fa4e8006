"""URL parts and rules by hand, the language model against a dictionary version."""

import math
from collections import Counter, defaultdict

import pytest

from stmtscope.llm import url_filter
from stmtscope.llm.queries import URL_RULES
from stmtscope.llm.scratch import Scratch
from stmtscope.llm.url_filter import END, ORDER, START, UNIFORM, filter_urls

CASES = [
    ("http://A.Example.NET/en/x?q=1", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://net/?q", "net", "/", "net/", "block"),
    ("http://shop.net", "shop.net", "", None, None),
    ("http://xnet/a", "xnet", "/a", None, None),
    ("https://example.com/de/1#top", "example.com", "/de/1", "example.com/de/", "block"),
    ("https://example.com/DE/1", "example.com", "/DE/1", None, None),
    ("ftp://b.org/fr/", "b.org", "/fr/", "org/fr/", "allow"),
    ("no scheme here", "", "", None, None),
    (None, "", "", None, None),
    ("", "", "", None, None),
    ("http://Ünï.org?x://y", "Ünï.org", "", None, None),
]


def test_parts_and_rules(spark):
    rows = [(i, c[0], "extra") for i, c in enumerate(CASES)] + [(None, CASES[0][0], None)]
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string, score string"), URL_RULES).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        r = by_id[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert by_id[None].verdict == "allow"


def test_no_rows_and_no_rules(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(empty, URL_RULES).collect() == []
    rows = spark.createDataFrame([(1, "http://a.com/b")], "page_id long, url string")
    assert [(r.verdict, r.score) for r in filter_urls(rows, ()).collect()] == [("allow", 0.0)]


def by_dictionary(labelled, subject):
    counts = {v: Counter() for v in ("allow", "block")}
    followers = {v: defaultdict(set) for v in counts}
    totals = {v: Counter() for v in counts}
    for text, verdict, n in labelled:
        marked = START * ORDER + text + END
        for i in range(ORDER, len(marked)):
            for k in range(ORDER + 1):
                context = marked[i - k : i]
                counts[verdict][context, marked[i]] += n
                totals[verdict][context] += n
                followers[verdict][context].add(marked[i])

    def p(v, context, c):
        shorter = p(v, context[1:], c) if context else UNIFORM
        t = len(followers[v][context])
        return (counts[v][context, c] + t * shorter) / (totals[v][context] + t) if totals[v][context] else shorter

    marked = START * ORDER + subject + END
    logs = [
        math.log(p("allow", marked[i - ORDER : i], marked[i])) - math.log(p("block", marked[i - ORDER : i], marked[i]))
        for i in range(ORDER, len(marked))
    ]
    return sum(logs) / len(logs)


def test_scores(spark):
    labelled = [("news.org/en/1", "allow", 3), ("news.org/en/23", "allow", 1), ("casino.net/win", "block", 2), ("win.net", "block", 1)]
    subjects = ["news.org/en/77", "bigcasino.net/", "", "zzz", "win.net"]
    with Scratch(spark) as scratch:
        model = url_filter.train(scratch, spark.createDataFrame(labelled, "subject string, verdict string, n long"))
        rows = spark.createDataFrame([(s,) for s in subjects], "subject string")
        got = {r.subject: r.score for r in url_filter.scored(scratch, rows, model).collect()}
    for s in subjects:
        assert got[s] == pytest.approx(by_dictionary(labelled, s), abs=1e-9), s


@pytest.mark.parametrize("hot_bits", [0, 3, 16])
def test_a_large_table_is_joined_without_frequent_keys(spark, monkeypatch, hot_bits):
    monkeypatch.setattr(url_filter, "SLOT_BITS", 3)
    monkeypatch.setattr(url_filter, "HOT_BITS", hot_bits)
    labelled = [("news.org/en/1", "allow", 3), ("casino.net/win", "block", 2)]
    subjects = ["news.org/en/77", "bigcasino.net/", "", "a" * 5000, "news.org/en/77"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with Scratch(spark) as scratch:
            model = url_filter.train(scratch, spark.createDataFrame(labelled, "subject string, verdict string, n long"))
            rows = spark.createDataFrame([(s, i) for i, s in enumerate(subjects)], "subject string, row_number int").repartition(3)
            found = url_filter.scored(scratch, rows, model).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    got = {r.row_number: r for r in found}
    assert len(found) == len(subjects)
    for i, s in enumerate(subjects):
        assert got[i].subject == s
        assert got[i].score == pytest.approx(by_dictionary(labelled, s), abs=1e-9), s


def test_both_plans_judge_alike(spark, monkeypatch):
    rows = [(i, f"http://host{i % 7}.{'org' if i % 2 else 'net'}/{'en' if i % 3 else 'win'}/{i}") for i in range(200)] + [(None, None)]
    rules = (("host1.org", "/", "allow"), ("host3.org", "/", "allow"), ("host2.net", "/", "block"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    small = {r.page_id: r for r in filter_urls(pages, rules).collect()}
    monkeypatch.setattr(url_filter, "SLOT_BITS", 3)
    monkeypatch.setattr(url_filter, "HOT_BITS", 4)
    large = {r.page_id: r for r in filter_urls(pages, rules).collect()}
    assert small.keys() == large.keys()
    for i, r in small.items():
        assert (r.host, r.path, r.rule, r.verdict) == (large[i].host, large[i].path, large[i].rule, large[i].verdict)
        assert r.score == pytest.approx(large[i].score, abs=1e-9)


def test_undecided_urls_are_told_apart(spark):
    """Hosts that no rule names, of the two kinds that the rules teach."""
    good = [f"http://news{i % 4}.{c}/en/article-{i}" for i in range(60) for c in ("org", "com")]
    bad = [f"http://casino{i % 4}.{c}/win-bonus-{i}" for i in range(60) for c in ("org", "com")]
    rules = [(f"{name}{i}.org", "/", verdict) for name, verdict in (("news", "allow"), ("casino", "block")) for i in range(4)]
    pages = spark.createDataFrame(list(enumerate(good + bad)), "page_id long, url string")
    undecided = [r for r in filter_urls(pages, rules).collect() if r.rule is None]
    assert len(undecided) == 120
    assert sum((r.verdict == "allow") == (r.page_id < len(good)) for r in undecided) >= 114
