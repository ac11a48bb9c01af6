"""Tail probabilities for the few result rows of a statistical test."""

from __future__ import annotations

import sys
from math import asin, erfc, exp, lgamma, log, pi, sqrt
from statistics import NormalDist

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NORMAL_FROM = 100_000  # degrees of freedom beyond which t and normal agree to all shown digits


def _beta_tail(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_tail(b, a, 1.0 - x)
    tiny = 1e-300
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(1 - x)) / a
    c, d = 1.0, 1.0 / max(1 - (a + b) * x / (a + 1), tiny)
    value = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for coefficient in (even, odd):
            d = 1 + coefficient * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1 + coefficient / c
            c = c if abs(c) > tiny else tiny
            step = d * c
            value *= step
        if abs(step - 1) < 1e-14:
            break
    return front * value


def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|); normal for a null or large number of degrees of freedom."""
    if df is None or df != df or df > NORMAL_FROM:
        return erfc(abs(t) / sqrt(2))
    return _beta_tail(df / 2, 0.5, df / (df + t * t))


def t_quantile(confidence: float, df: float) -> float:
    """The t with P(|T| <= t) = confidence."""
    if df > NORMAL_FROM:
        return NormalDist().inv_cdf((1 + confidence) / 2)
    low, high = 0.0, 1e4
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if t_two_sided(middle, df) > 1 - confidence else (low, middle)
    return (low + high) / 2


@F.pandas_udf(T.DoubleType())
def p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of a t (or, with null df, normal) statistic."""
    return pd.Series(
        [None if s is None or s != s else t_two_sided(s, d) for s, d in zip(t, df)], dtype="float64"
    )


@F.pandas_udf(T.DoubleType())
def critical_t(confidence: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_quantile(c, d) if d == d and d > 0 else None for c, d in zip(confidence, df)], dtype="float64")


# The polynomials of Royston's approximation (1995) to the weights and the tail of the Shapiro-Wilk test,
# lowest power first.
LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056)
NEXT_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
FEW_SHIFT = (-2.273, 0.459)
FEW_MEAN, FEW_SPREAD = (0.544, -0.39978, 0.025054, -0.0006714), (1.3822, -0.77857, 0.062767, -0.0020322)
MANY_MEAN, MANY_SPREAD = (-1.5861, -0.31082, -0.083751, 0.0038915), (-0.4803, -0.082676, 0.0030302)
FEW, EDGE = 11, 64
_NORMAL = NormalDist()


def _polynomial(coefficients: tuple[float, ...], x: float) -> float:
    return sum(c * x**k for k, c in enumerate(coefficients))


def _score(rank: float, n: int) -> float:
    """Expected normal order statistic of a rank, by Blom's formula."""
    return _NORMAL.inv_cdf((rank - 0.375) / (n + 0.25))


def score_sum(first: int, last: int, n: int, square: bool = False) -> float:
    """Sum of the scores (or their squares) of the ranks first .. last of n.

    The outermost ranks are added one by one; ranks between by the integral, which is known, and one correction term.
    """
    total, lo, hi = 0.0, max(first, EDGE + 1), min(last, n - EDGE)
    if hi - lo < EDGE:
        lo, hi = last + 1, last
    for rank in (*range(first, min(lo, last + 1)), *range(max(hi + 1, lo, first), last + 1)):
        m = _score(rank, n)
        total += m * m if square else m
    if lo > hi:
        return total
    width = n + 0.25
    for rank, sign in ((hi + 0.5, 1), (lo - 0.5, -1)):
        z = _score(rank, n)
        density = _NORMAL.pdf(z)
        integral = width * ((_NORMAL.cdf(z) - z * density) if square else -density)
        slope = (2 * z if square else 1.0) / (width * density)
        total += sign * (integral - slope / 24)
    return total


@F.pandas_udf(T.DoubleType())
def inner_score_sum(below: pd.Series, rows: pd.Series, n: pd.Series) -> pd.Series:
    """Scores of the ranks a value holds, without the outermost ranks, whose weights are not scores."""
    out = []
    for b, k, m in zip(below.tolist(), rows.tolist(), n.tolist()):
        outer = 1 if m <= 5 else 2
        first, last = max(b + 1, outer + 1), min(b + k, m - outer)
        out.append(score_sum(int(first), int(last), int(m)) if first <= last else 0.0)
    return pd.Series(out, dtype="float64")


def shapiro_w(n: int, squares: float, inner: float, low: float, low_2: float, high_2: float, high: float) -> float:
    """W from the sum of squared deviations, the inner values weighted by their scores, and the outermost values."""
    if n == 3:
        weighted = sqrt(0.5) * (high - low)
    else:
        total = score_sum(1, n, n, square=True)
        unit, last, next_ = 1 / sqrt(n), _score(n, n), _score(n - 1, n)
        a = _polynomial(LAST_WEIGHT, unit) + last / sqrt(total)
        if n <= 5:
            scale = (total - 2 * last * last) / (1 - 2 * a * a)
            weighted = inner / sqrt(scale) + a * (high - low)
        else:
            b = _polynomial(NEXT_WEIGHT, unit) + next_ / sqrt(total)
            scale = (total - 2 * last * last - 2 * next_ * next_) / (1 - 2 * a * a - 2 * b * b)
            weighted = inner / sqrt(scale) + a * (high - low) + b * (high_2 - low_2)
    return min(weighted * weighted / squares, 1.0)


def shapiro_tail(w: float, n: int) -> float:
    """Chance of a W as small, or smaller, under normality."""
    if n == 3:
        return max(0.0, 6 / pi * (asin(sqrt(w)) - asin(sqrt(0.75))))
    if w >= 1:
        return 1.0
    x = log(1 - w)
    if n <= FEW:
        gamma = _polynomial(FEW_SHIFT, n)
        if x >= gamma:
            return 0.0
        x, mean, spread = -log(gamma - x), _polynomial(FEW_MEAN, n), exp(_polynomial(FEW_SPREAD, n))
    else:
        mean, spread = _polynomial(MANY_MEAN, log(n)), exp(_polynomial(MANY_SPREAD, log(n)))
    return erfc((x - mean) / spread / sqrt(2)) / 2


@F.pandas_udf(T.StructType([T.StructField("w", T.DoubleType()), T.StructField("p_value", T.DoubleType())]))
def shapiro(n: pd.Series, squares: pd.Series, inner: pd.Series, low: pd.Series, low_2: pd.Series, high_2: pd.Series, high: pd.Series) -> pd.DataFrame:
    """W and its p-value; null for fewer than three rows or rows that are all equal."""
    out = []
    for m, s, *rest in zip(n, squares, inner, low, low_2, high_2, high):
        w = shapiro_w(int(m), s, *rest) if m >= 3 and s > 0 else None
        out.append((w, None if w is None else shapiro_tail(w, int(m))))
    return pd.DataFrame(out, columns=["w", "p_value"], dtype="float64")
