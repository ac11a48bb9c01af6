"""Exact quantiles from sketches and brackets, also when a bracket is wrong."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.operators import brackets, profile


def test_describe_equals_numpy(spark):
    rng = np.random.default_rng(3)
    n = 5000
    rows = [
        (float(rng.normal()), float(rng.integers(0, 4)), None if i % 3 else float(i), float("nan") if i % 2 else 1.0, int(rng.integers(-50, 50)))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "a double, ties double, gaps double, nans double, whole int").repartition(6)
    got = {r["column"]: r for r in profile.describe_numeric(df).collect()}
    for i, name in enumerate(df.columns):
        v = np.array([r[i] for r in rows if r[i] is not None and r[i] == r[i]], float)
        r = got[name]
        assert r["count"] == len(v)
        want = [v.mean(), v.std(ddof=1), v.min(), *np.percentile(v, [25, 50, 75]), v.max()]
        assert [r[c] for c in ("mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(want)


@pytest.mark.parametrize("most", [10, 200_000])
def test_wrong_brackets_are_widened(spark, monkeypatch, most):
    monkeypatch.setattr(brackets, "MOST_VALUES", most)
    values = [float((i * 7919) % 1000) / 8 for i in range(1000)] + [float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    known = [v for v in values if v is not None]
    ends = {("v", 0.25): (90.0, 100.0), ("v", 0.5): (1.0, 2.0), ("v", 0.75): (None, 93.0), ("v", 1.0): (None, None), ("v", 0.0): (5.0, 5.0)}
    got = brackets.exact_in_brackets(df, {"v": len(known)}, ends)
    known.sort()
    for (_, p), v in got.items():
        low, part = divmod(p * (len(known) - 1), 1)
        a, b = known[int(low)], known[min(int(low) + 1, len(known) - 1)]
        assert v == (a + (b - a) * part if part else a)


def test_a_column_without_values(spark):
    df = spark.createDataFrame([(None, 1.0)], "none double, one double")
    got = {r["column"]: r for r in profile.describe_numeric(df).collect()}
    assert got["none"]["count"] == 0 and got["none"]["p50"] is None and got["none"]["max"] is None
    assert (got["one"]["p25"], got["one"]["p75"], got["one"]["std"]) == (1.0, 1.0, None)


def test_rows_are_not_shuffled(spark):
    df = spark.range(100_000).select(F.col("id").cast("double").alias("v"))
    plan = brackets.select_inside(df, [(0, "v", 49_000.0, 51_000.0)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    inside = brackets.select_inside(df, [(0, "v", 49_000.0, 51_000.0)])
    assert inside.filter("value IS NULL").first()["n"] == 49_000
    assert inside.filter("value IS NOT NULL").count() == 2001
