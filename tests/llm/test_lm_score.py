"""Language model: word frequencies by hand, normalisation, and a gain on held-out texts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from stmtscope.llm import lm_score
from stmtscope.llm.lm_score import UNITS, lm_scores, train


def two_languages(n=240):
    rng = random.Random(4)
    vocabularies = [[f"{a}{b}" for a in "pqrst" for b in vowels] for vowels in ("ao", "ei")]
    rows = []
    for i in range(n):
        words = vocabularies[i % 2]
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))))
    return rows


@pytest.mark.parametrize("slots", [1 << 18, 4])
def test_scores(spark, monkeypatch, slots):
    monkeypatch.setattr(lm_score, "SLOTS", slots)
    rows = two_languages() + [(1000, None), (1000, ""), (None, "pa unknown Pa"), (1001, "\tpa  PA\n")]
    got = lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows)
    held_out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").lower().split(), None]
    counts = Counter(w for i, t in rows if not held_out(i) for w in tokens(t))
    total = sum(counts.values())
    want = Counter()
    for i, t in rows:
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in tokens(t))
        want[i, held_out(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    if slots > 4:
        held = [r for r in got if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.05 * sum(r.n_tokens for r in held)


def test_nothing_to_learn_from(spark):
    assert lm_scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    only_held_out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    [r] = lm_scores(spark.createDataFrame([(only_held_out, "a b")], "doc_id long, text string")).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)
    assert r.score == pytest.approx(-3 * math.log10(UNITS), abs=1e-4)


def test_probabilities_are_normalised_and_learned():
    rng = np.random.default_rng(0)
    counts = np.zeros((UNITS, UNITS, UNITS), np.int64)
    for a in range(6):
        counts[:, a, (a + 1) % 6] += 50 + rng.integers(0, 9, UNITS)
    p = 10.0 ** train(counts.ravel()).reshape(UNITS, UNITS, UNITS).astype(np.float64)
    assert np.allclose(p.sum(axis=2), 1, atol=1e-4)
    assert all(p[3, a].argmax() == (a + 1) % 6 and p[3, a].max() > 0.5 for a in range(6))


def test_rare_words_tell_rare_words(spark):
    """Words outside the frequent ones, all in one unit, follow words of their own language."""
    rng = random.Random(5)
    languages = [[f"{side}{i}xx" for i in range(300)] for side in "pq"]
    rows = [(i, " ".join(rng.choices(languages[i % 2], k=100))) for i in range(600)]
    got = lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.15 * sum(r.n_tokens for r in held)


def test_all_levels_are_normalised():
    rng = np.random.default_rng(1)
    n_own, n_other = 400, 50
    word, count = rng.integers(1, 1 << 62, n_own + n_other), rng.integers(40, 90, n_own + n_other)
    unit = rng.integers(lm_score.OWN_UNITS, UNITS, n_own + n_other).astype(np.int16)
    count[n_own:] = 3
    own = np.where(np.arange(n_own + n_other) < n_own, np.arange(n_own + n_other), -1).astype(np.int32)
    total = np.bincount(unit, count + 1, UNITS) + 1
    last = lambda x, value: np.append(x, np.array([value], x.dtype))
    table = lm_score.Lexicon(
        last(word, 0), last(count, 0), last(unit, 0), last(own, -1), lm_score.places(word), int(count.sum()), len(word), total
    )
    found, n, units, numbers = table.look_up(np.append(word, 12345), np.full(len(word) + 1, 3))
    assert found.tolist() == [True] * len(word) + [False] and n[:-1].tolist() == count.tolist() and units[-1] == lm_score.OWN_UNITS + 3
    width = 2 * lm_score.SIZE
    sums = rng.normal(0, 20, (n_own + lm_score.SHARED_UNITS + width, width))
    sums[-width:] = np.eye(width) * total.sum() * 2
    inner = lm_score.target_classes(table, sums)
    f = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    size = UNITS + n_own
    vectors = lm_score.Vectors(f(size, lm_score.SIZE), f(size, lm_score.SIZE), f(size, lm_score.SIZE), f(UNITS, lm_score.SIZE), f(UNITS), abs(f(width)) + 1)
    # Two words before, then each unit with a word of its own, each word, and each unit's other words.
    ends = [(u, -1) for u in range(UNITS)] + [(int(unit[i]), i) for i in range(n_own)]
    units = np.array([x for u, _ in ends for x in (int(unit[5]), int(unit[9]), u)])
    numbers = np.array([x for _, w in ends for x in (5, 9, w)])
    first = np.arange(0, len(units) + 1, 3)
    log_p = np.zeros(UNITS**3, np.float32)
    score = lm_score.log_probabilities(vectors, inner, table, log_p, units, numbers, first)
    assert (10.0 ** score[2::3]).sum() == pytest.approx(1, abs=1e-4)
    assert (lm_score.other_places(table) >= 1).all()
