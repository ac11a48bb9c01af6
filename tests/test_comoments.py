"""Co-moments of all pairs from one scan, against numpy."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from adlens.operators import profile, selection
from adlens.operators.comoments import CoMoments


def test_pairs_with_gaps_equal_pandas(spark):
    rng = np.random.default_rng(2)
    n = 3000
    a = rng.normal(size=n)
    frame = pd.DataFrame({"a": a, "b": a * 2 + rng.normal(size=n), "c": rng.normal(size=n) + 1e9, "flat": 0.1, "gap": a, "half": a})
    frame.loc[rng.random(n) < 0.4, "gap"] = np.nan
    frame["half"] = np.where(np.isnan(frame["gap"]), rng.normal(size=n), 7.3)  # constant wherever `gap` is present
    frame.loc[5, "b"] = np.inf
    df = spark.createDataFrame(frame).repartition(7)
    got = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in selection.correlation_pairs(df).collect()}
    clean = frame.replace(np.inf, np.nan)
    for x, y in combinations(frame.columns, 2):
        both = clean[[x, y]].dropna()
        if both[x].nunique() < 2 or both[y].nunique() < 2:
            assert got[x, y] is None
        else:
            u, v = both[x] - both[x].iloc[0], both[y] - both[y].iloc[0]
            assert got[x, y] == pytest.approx(abs(np.corrcoef(u, v)[0, 1]), abs=1e-7)
    assert got["gap", "half"] is None and got["a", "flat"] is None


def test_merging_does_not_depend_on_the_cut():
    rng = np.random.default_rng(4)
    values = rng.normal(size=(500, 4)) * [1, 1e6, 1e-6, 1] + [0, 1e9, 5, 0]
    values[rng.random(values.shape) < 0.3] = np.nan
    whole = CoMoments.of(values)
    parts = CoMoments.empty(4, 4)
    for part in np.array_split(values, [0, 1, 50, 51, 300]):
        parts = parts.merged(CoMoments.of(part))
    for name in ("n", "mean", "low", "high"):
        assert np.allclose(getattr(parts, name), getattr(whole, name), rtol=1e-12)
    assert np.allclose(parts.spread, whole.spread, rtol=1e-9)
    for i, j in combinations(range(4), 2):
        both = values[~np.isnan(values[:, [i, j]]).any(axis=1)][:, [i, j]]
        assert parts.correlations()[i, j] == pytest.approx(np.corrcoef(both - both.mean(axis=0), rowvar=False)[0, 1], abs=1e-9)


def test_columns_without_rows_or_pairs(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, None)], "a double, b double")
    assert selection.correlation_pairs(df).first()["correlation"] is None
    assert selection.correlation_pairs(df.limit(0)).first()["correlation"] is None
    assert selection.correlation_pairs(df.select("a")).count() == 0


def test_trend_line_keeps_its_digits(spark):
    """Two frequencies that differ by one in half a million: uncentred third powers lose the difference."""
    sizes = [400_000, 400_001, 400_002]
    clicks = [100_000, 100_001, 100_004]
    df = spark.range(sum(sizes)).selectExpr(
        f"CASE WHEN id < {sizes[0]} THEN 'a' WHEN id < {sizes[0] + sizes[1]} THEN 'b' ELSE 'c' END AS user_id",
        f"""CAST(CASE WHEN id < {sizes[0]} THEN id < {clicks[0]} WHEN id < {sizes[0] + sizes[1]} THEN id - {sizes[0]} < {clicks[1]}
            ELSE id - {sizes[0] + sizes[1]} < {clicks[2]} END AS INT) AS clicked""",
    )
    from fractions import Fraction as Q

    n, sx = sum(sizes), sum(f * f for f in sizes)
    mf, my = Q(sx, n), Q(sum(clicks), n)
    slope = sum((f - mf) * (y - f * my) for f, y in zip(sizes, clicks)) / sum(f * (f - mf) ** 2 for f in sizes)
    got = profile.trend_line(df).first()
    assert got["slope"] == pytest.approx(float(slope), rel=1e-6)
    assert got["intercept"] == pytest.approx(float(my - slope * mf), rel=1e-6)
