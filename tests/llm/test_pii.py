"""Personal data: base spans against the patterns as written, and what the field adds."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from stmtscope.llm.pii import KINDS, Field, Graph, N_FEATURES, base_spans, cells_of, find_personal_data, fit, graph_of, luhn, redact, train

TEXTS = [
    "write to a.b+c@mail-1.example.com, or x@y or a@b@c.de and 1@2.3.4",
    "ip 1.2.3.4.5 and 999.1.1.1 and 010.0.0.255 and 1.2.3",
    "card 4387513035237269 or 4387-5130-3523-7269 or 4387 5130 3523 7268",
    "phone +1 (456) 555-2186 and +49 30 1234567 and +1-2 and +123",
    "call +1 (269) 555-3296 4524132264652876 now",
    "",
    "é@ü.com é a@b.com é",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2",
    "+" * 50 + "1" * 50,
    "a" * 5000 + "@" + "b" * 5000,
    "9" * 6000 + ".1.1.1",
]


def as_written(text):
    found = [("email", m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", m.span()))
    return found


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert [(KINDS[k], (a, b)) for k, a, b in base_spans(text)] == as_written(text)


def test_base_spans_of_noise():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789..@@+- ()ab-") for _ in range(rng.randrange(60)))
        assert [(KINDS[k], (a, b)) for k, a, b in base_spans(text)] == as_written(text), text


def samples():
    rng = random.Random(2)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    out = []
    for _ in range(300):
        card = "4" + digits(14)
        card += next(d for d in "0123456789" if luhn(card + d))
        phone = f"+1 ({rng.randrange(200, 999)}) 555-{digits(4)}"
        wanted = [card, phone, f"user.{digits(2)}@mail{digits(1)}.example.com", f"{rng.randrange(255)}.1.2.{rng.randrange(255)}", f"order {digits(8)}"]
        out.append("\n".join(rng.sample(wanted, 2)))
    return out


def test_the_field_adds_consistent_spans():
    field = fit(cells_of(samples()))
    added = lambda t: [(KINDS[k], t[a:b]) for k, a, b in field.added(g)] if (g := graph_of(t, base_spans(t))) else []
    far = " and so on" * 300
    assert added(f"call +1 (456) 555-2186{far} or (456) 555-2186") == [("phone", "(456) 555-2186")]
    assert added(f"mail hsr.29@mail5.example.com{far} from hsr.29, thanks") == [("email", "hsr.29")]
    assert added("call +1 (269) 555-3296 4524132264652876 now") == [("phone", "+1 (269) 555-3296"), ("card", "4524132264652876")]
    for clean in ("order 12345678 of 2024-01-05", "hash 3b579d3cee1dcaf48e80dfd04d785e892fc7d365", "no 1234567890123456", "plain text"):
        assert added(clean) == [], clean


def test_marginals_by_enumeration():
    rng = np.random.default_rng(5)
    none = len(KINDS)
    for n, skip in ((4, []), (4, [(0, 3)]), (5, [(0, 2), (2, 4)])):
        for _ in range(5):
            features = rng.integers(0, 2, (n, N_FEATURES)).astype(float)
            label = np.full(n, -1)
            label[0] = rng.integers(0, none)
            chain = np.stack([np.arange(n - 1), np.arange(1, n)], axis=1)
            field = Field(rng.normal(0, 1, (N_FEATURES, none + 1)), -0.3, 1.0)
            graph = Graph([(i, i + 1) for i in range(n)], label, features, chain, np.array(skip, np.int64).reshape(-1, 2))
            unary = features @ field.unary
            unary[:, -1] += 3.0
            unary[0] = -30.0
            unary[0, label[0]] = 0.0
            p = np.zeros((n, none + 1))
            for y in itertools.product(range(none + 1), repeat=n):
                score = sum(unary[i, y[i]] for i in range(n))
                score += sum(field.chain for i, j in chain if y[i] == y[j]) + sum(field.skip for i, j in skip if y[i] == y[j])
                for i in range(n):
                    p[i, y[i]] += np.exp(score)
            p /= p.sum(axis=1, keepdims=True)
            # Exact without a loop but for the damped messages, near it with loops.
            assert np.abs(field.marginals(graph) - p).max() < (0.15 if skip else 0.01)


def test_weights_come_from_all_rows(spark):
    texts = [t for t in samples() * 20] + ["again a1@b.com and a1@b.com"] * 50 + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    got, wanted = train(docs), fit(cells_of([t for t in texts if t]))
    assert np.allclose(got.unary, wanted.unary)
    assert (got.chain, got.skip) == pytest.approx((wanted.chain, wanted.skip))
    assert got.skip > fit(cells_of(samples())).skip  # 50 agreeing pairs speak for it


def test_repeats_without_their_mark_are_found():
    field = fit(cells_of(samples()))
    rng = random.Random(9)
    found = clean = 0
    for _ in range(200):
        area, number = rng.randrange(200, 999), f"555-{rng.randrange(1000, 9999)}"
        text = f"call +1 ({area}) {number}" + " filler words" * rng.randrange(200) + f" or ({area}) {number}, order {rng.randrange(10**7, 10**8)}"
        added = [text[a:b] for _, a, b in field.added(graph_of(text, base_spans(text)))]
        found += f"({area}) {number}" in added
        clean += all(not t.isdecimal() for t in added)
    assert found >= 190 and clean >= 190


def test_query(spark, edge_docs, no_docs):
    rows = [(i, t) for i, t in enumerate(TEXTS + samples())] + [(None, "a@b.com")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(edge_docs.select("doc_id", "text"))
    got = find_personal_data(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got if r.doc_id not in (None, *range(1, 9))}
    for i, t in rows[9:-1]:
        spans = sorted(as_written(t), key=lambda s: (KINDS.index(s[0]), s[1]))
        base = ",".join(f"{k}:{a}:{b}" for k, (a, b) in spans)
        r = by_id[i]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _ in spans) for kind in KINDS)
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
    assert find_personal_data(no_docs).collect() == []


def test_redact(spark, edge_docs):
    rows = [(1, "to a@b.com or +1 (456) 555-2186."), (2, None), (3, "plain")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: (r.text, r.spans) for r in redact(docs).collect()}
    assert got == {1: ("to [EMAIL] or [PHONE].", "z"), 2: (None, "z"), 3: ("plain", "z")}
    assert sorted(map(repr, redact(edge_docs).collect())) == sorted(map(repr, edge_docs.collect()))
