"""Choices are scored without a pass for the highest score, also where exp alone would fail."""

import numpy as np
import pytest

from stmtscope.llm import lm_score


def exact(f, q, chosen):
    scores = f.astype(np.float64) @ q
    high = scores.max(axis=1)
    return scores[np.arange(len(f)), chosen] - high - np.log(np.exp(scores - high[:, None]).sum(axis=1))


@pytest.mark.parametrize("size", [1, 40, 400])  # 400: sums beyond single floats, and sums of zeros
def test_choices_equal_exact_ones(size):
    rng = np.random.default_rng(5)
    widths, n = [7, 0, 1, 900, 30], 300
    columns = [rng.normal(0, 1, (9, w)).astype(np.float32) for w in widths]
    group = np.sort(rng.choice([0, 2, 3, 4], n))
    f = rng.normal(0, size, (n, 9)).astype(np.float32)
    chosen = np.array([rng.integers(0, widths[g]) for g in group])
    with np.errstate(over="ignore", under="ignore"):
        found = lm_score._grouped_choices(f, group, columns, chosen)
    for g in (0, 2, 3, 4):
        rows = group == g
        assert found[rows] == pytest.approx(exact(f[rows], columns[g], chosen[rows]), rel=1e-4, abs=1e-3)
    assert np.isfinite(found).all() and (found[group == 2] == 0).all()


def test_signs_come_from_the_hashes():
    hashes = np.random.default_rng(6).integers(-(1 << 62), 1 << 62, 100)
    values = np.linspace(0, 1, 100)
    for k, column in enumerate(lm_score._signed(hashes, values)):
        assert column == pytest.approx(values * (((hashes >> (40 + k)) & 1) * 2 - 1))
