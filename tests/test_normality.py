"""Shapiro-Wilk against published values and a plain sum over all rows."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pytest

from adlens.functions import stats
from adlens.operators import abtest

# Published: W and p of the weights of eleven men (Shapiro and Wilk, 1965; p after Royston), and of two samples of twenty.
PUBLISHED = [
    ([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236], 0.78881, 0.006704),
    ([0.11, 7.87, 4.61, 10.14, 7.95, 3.14, 0.46, 4.43, 0.21, 4.75, 0.71, 1.52, 3.24, 0.93, 0.42, 4.97, 9.53, 4.55, 0.47, 6.66], 0.900473, 0.042090),
    ([1.36, 1.14, 2.92, 2.55, 1.46, 1.06, 5.27, -1.11, 3.48, 1.10, 0.88, -0.51, 1.46, 0.52, 6.20, 1.69, 0.08, 3.67, 2.81, 3.49], 0.959027, 0.52460),
]


def table(spark, samples):
    rows = [(str(k), "A", float(v)) for k, own in enumerate(samples) for v in own]
    return spark.createDataFrame(rows, "test_id string, variant string, value double").repartition(4)


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_published_values(spark, hot_rows):
    got = {r["test_id"]: r for r in abtest.ab_shapiro(table(spark, [p[0] for p in PUBLISHED]), hot_rows).collect()}
    for k, (own, w, p) in enumerate(PUBLISHED):
        r = got[str(k)]
        assert (r["n"], r["w"], r["p_value"]) == (len(own), pytest.approx(w, abs=1e-3), pytest.approx(p, abs=1e-3))
        assert r["w"] == pytest.approx(w, abs=2e-5)


def plain_w(values):
    x, n = np.sort(values), len(values)
    m = np.array([NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    u, total = n**-0.5, (m**2).sum()
    a = np.polyval(stats.LAST_WEIGHT[::-1], u) + m[-1] / np.sqrt(total)
    weights = m / np.sqrt((total - 2 * m[-1] ** 2) / (1 - 2 * a * a))
    if n > 5:
        b = np.polyval(stats.NEXT_WEIGHT[::-1], u) + m[-2] / np.sqrt(total)
        weights = m / np.sqrt((total - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * a * a - 2 * b * b))
        weights[-2], weights[1] = b, -b
    weights[-1], weights[0] = a, -a
    return (weights @ x) ** 2 / ((x - x.mean()) ** 2).sum()


def test_ties_and_sizes_equal_a_plain_sum(spark):
    rng = np.random.default_rng(6)
    samples = [
        rng.normal(size=4), rng.normal(size=5), rng.normal(size=6), rng.normal(size=12), rng.integers(0, 4, 3000).astype(float),
        np.round(rng.normal(size=2000) * 5), rng.exponential(size=700), [1e9 + v for v in rng.normal(size=300)],
    ]
    got = {r["test_id"]: r["w"] for r in abtest.ab_shapiro(table(spark, samples)).collect()}
    for k, own in enumerate(samples):
        assert got[str(k)] == pytest.approx(plain_w(np.array(own)), abs=1e-6)


def test_sums_of_scores():
    for n, first, last in ((5000, 1, 5000), (5000, 300, 4000), (5000, 1, 700), (200, 3, 190), (5000, 4990, 5000), (10, 2, 2)):
        m = np.array([NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(first, last + 1)])
        assert stats.score_sum(first, last, n) == pytest.approx(m.sum(), abs=1e-6)
        assert stats.score_sum(first, last, n, square=True) == pytest.approx((m**2).sum(), abs=1e-6)


def test_three_rows_and_too_few(spark):
    samples = [[1, 2, 4], [1, 2], [5], [3, 3, 3, 3], [0, 0, 1]]
    got = {r["test_id"]: (r["w"], r["p_value"]) for r in abtest.ab_shapiro(table(spark, samples)).collect()}
    assert got["0"] == (pytest.approx(0.964286, abs=1e-5), pytest.approx(0.636887, abs=1e-5))
    assert got["1"] == got["2"] == got["3"] == (None, None)
    assert got["4"] == (pytest.approx(0.75), pytest.approx(0.0, abs=1e-6))
