"""Whitening against a plain eigenvalue decomposition."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.llm import whitening
from adlens.llm.queries import op11_whitening

SCHEMA = "vec_id long, embedding array<float>, id string, vector int, whitened double"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 0.5) for i, v in rows], SCHEMA)


def whole(rows):
    return np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows], np.int64)


def plain(x):
    """Eigenvalues by fall, unit eigenvectors as columns, and exact deviations."""
    n, sums = len(x), x.sum(axis=0)
    y = (n * x - sums) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return values[::-1], vectors[:, ::-1], y, exact


def random_rows(n, d, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d)) * np.geomspace(1, spread, d)
    return [(int(i), [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(n, d)) @ mix)]


def test_against_eigenvectors(spark):
    rows = random_rows(700, 40, spread=0.05)
    values, vectors, y, exact = plain(whole(rows))
    got, fit = whitening.whiten(table(spark, rows).repartition(7))
    assert fit.n == 700 and fit.components.shape == (40, 32)
    assert np.allclose(fit.variances, values[:32], rtol=1e-9)
    assert np.allclose(np.abs((fit.components * vectors[:, :32]).sum(axis=0)), 1, atol=1e-9)
    assert np.allclose(fit.explained, values[:32] / values.sum(), rtol=1e-9)
    for r in got.collect():
        assert r.deviation == exact[r.id]
        assert np.allclose(r.whitened, (y[r.id] @ fit.components) / np.sqrt(fit.variances))
    error = whitening.identity_error(table(spark, rows).select(F.col("embedding").cast("array<double>")), fit)
    assert error < 1e-10


def test_badly_conditioned_rows_keep_small_components(spark):
    """Spread of a million between components: the covariance's own condition is 10**12."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 6)) * np.array([1e7, 1e5, 1e3, 300, 100, 30]))
    rows = [(i, [float(c) / 64 for c in v]) for i, v in enumerate(x)]
    values, _, _, _ = plain(whole(rows))
    _, fit = whitening.whiten(table(spark, rows))
    centred = whole(rows) - whole(rows).mean(axis=0)
    sigma = np.linalg.svd(centred, compute_uv=False)
    assert len(fit.variances) == 6
    assert np.allclose(fit.variances, sigma**2 / 400, rtol=1e-6)


def test_rank_deficient_rows_have_fewer_components(spark):
    rows = random_rows(60, 5)
    rows = [(i, [*v, v[0], 0.25, 0.0]) for i, v in rows]  # a repeated column and two constant ones
    _, fit = whitening.whiten(table(spark, rows))
    assert len(fit.variances) == 5
    few = random_rows(4, 6)
    assert len(whitening.whiten(table(spark, few))[1].variances) == 3


def test_rows_that_do_not_count_and_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(None, [0.1, 0.2]), (7, [0.5, -0.25]), (7, [0.5, -0.25]), (2**60 + 1, [1.0, 3.0]), (2**60 + 3, [-1.0])]
    bad = [(1, None), (2, [0.1, None]), (3, [nan, 0.1]), (4, [0.1, -inf])]
    got, fit = whitening.whiten(table(spark, [*bad, *good]).coalesce(1))
    assert fit.n == 5
    rows = got.collect()
    assert sorted(str(r.id) for r in rows) == sorted(str(i) for i, _ in good)
    x = whole([(i, [*v, 0.0][:2]) for i, v in good])
    assert fit.sums.tolist() == x.sum(axis=0).tolist()
    equal = [r.whitened for r in rows if r.id == 7]
    assert equal[0] == equal[1]


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, [])], [(1, None)], [(1, [1.0, 2.0])]])
def test_no_variance_gives_no_rows(spark, rows):
    got, fit = whitening.whiten(table(spark, rows))
    assert fit is None and got.count() == 0
    assert got.columns == ["id", "deviation", "whitened"]


def test_deviations_beyond_doubles_are_exact():
    x = np.array([[10**6 + 5, 10**6], [10**6, 10**6 + 10**5]], np.int64)
    n = 3 * 10**3
    sums = np.array([3 * 10**9 + 12345, 3 * 10**9 + 54321], np.int64)
    want = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    assert whitening.deviations(x, n, sums).tolist() == want
    with pytest.raises(OverflowError):
        whitening.deviations(np.array([[4 * 10**9, 0]], np.int64), 2, np.array([0, 0], np.int64))


def test_query(spark):
    rows = op11_whitening(spark, "/root/testdata/sf0.001")
    frame = rows.toPandas()
    source = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").toPandas()
    x = whole(list(zip(source["vec_id"], source["embedding"], strict=True)))
    values, vectors, y, exact = plain(x)
    assert len(frame) == 32 * len(x) and set(frame["n"]) == {len(x)}
    assert frame["identity_error"].nunique() == 1 and frame["identity_error"][0] < 1e-6
    one = frame[frame["component"] == 3].set_index("vec_id").loc[source["vec_id"]]
    want = y @ vectors[:, 2] / np.sqrt(values[2])
    assert np.allclose(one["whitened"], want, atol=1e-8) or np.allclose(one["whitened"], -want, atol=1e-8)
    assert one["deviation"].tolist() == exact
    assert np.allclose(one["explained"], values[2] / values.sum())
