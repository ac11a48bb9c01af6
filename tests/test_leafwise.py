"""Leaf-wise trees against a plain best-first loop over the same bins."""

from __future__ import annotations

import heapq

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from adlens.operators import leafwise, models
from adlens.operators.leafwise import LeafwiseModel, Options, best_split

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(1500, 3)), 1)
    odds = 2 * (x[:, 0] > 0.3) * (x[:, 1] < 0.5) - 1 + 1.5 * (np.abs(x[:, 0] + 1) < 0.3)
    y = (rng.random(1500) < 1 / (1 + np.exp(-odds))).astype(int)
    return x, y


@pytest.fixture(scope="module")
def table(spark, rows):
    x, y = rows
    lines = [(i, *map(float, v), int(t), i % 4 == 0) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(lines, "id long, a double, b double, c double, clicked int, held boolean").repartition(3).cache()


def plain_tree(bins, gradient, hessian, leaves, depth, options):
    """Best-first growth by hand: (leaf of each row, number of leaves)."""

    def histogram(at):
        out = np.zeros((bins.shape[1], 256, 3))
        for f in range(bins.shape[1]):
            for k, v in enumerate((gradient[at], hessian[at], np.ones(len(at)))):
                np.add.at(out[f, :, k], bins[at, f], v)
        return out

    def candidate(at, level):
        gain, feature, cut = best_split(histogram(at), list(range(bins.shape[1])), options)
        return (-gain, feature, cut, at, level)

    done, queue, n = [], [], 0
    first = candidate(np.arange(len(bins)), 0)
    queue.append((first[0], n, first))
    taken = 1
    while queue and taken < leaves:
        _, _, (gain, feature, cut, at, level) = heapq.heappop(queue)
        if gain >= 0 or level >= depth:
            done.append(at)
            continue
        taken += 1
        goes = bins[at, feature] <= cut
        for part in (at[goes], at[~goes]):
            n += 1
            one = candidate(part, level + 1)
            heapq.heappush(queue, (one[0], n, one))
    return [*done, *[q[2][3] for q in queue]]


def test_trees_equal_plain_best_first_growth(table, rows):
    x, y = rows
    options = dict(rounds=2, leaves=9, max_depth=4, subsample=1.0, column_sample=1.0, least_rows=15)
    model = models.train_gbt_leaf(table, FEATURES, row_id="id", **options)
    bins = leafwise.binned(x, model.edges)
    weight = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0)
    margin = np.full(len(y), model.base)
    for nodes in model.trees:
        rate = 1 / (1 + np.exp(-margin))
        g, h = weight * (rate - y), weight * rate * (1 - rate)
        parts = plain_tree(bins, g, h, 9, 4, Options(**options))
        at = leafwise.routes(leafwise.shape_of(nodes), bins)
        assert sum(n.left < 0 for n in nodes) == len(parts) <= 9
        assert sorted(map(tuple, (np.flatnonzero(at == k) for k in np.unique(at)))) == sorted(tuple(np.sort(p)) for p in parts)
        for k, n in enumerate(nodes):
            if n.left < 0:
                mine = at == k
                assert n.value == pytest.approx(-0.1 * g[mine].sum() / h[mine].sum(), rel=1e-6)
                assert n.rows == mine.sum()
        margin = margin + np.array([n.value for n in nodes])[at]
    assert model.margin(x) == pytest.approx(margin)


def test_leaves_have_unequal_depth_and_loss_falls(table, rows):
    x, y = rows
    model = models.train_gbt_leaf(table, FEATURES, row_id="id", rounds=10, leaves=16, max_depth=6)
    depths = [n.depth for n in model.trees[0] if n.left < 0]
    assert len(depths) <= 16 and max(depths) <= 6 and len(set(depths)) > 1
    loss = lambda k: np.logaddexp(0, np.where(y == 1, -1, 1) * LeafwiseModel(model.base, model.trees[:k], model.edges).margin(x)).mean()
    assert loss(10) < loss(5) < loss(0)
    importances = model.featureImportances.toArray()
    assert importances.sum() == pytest.approx(1) and importances[2] < min(importances[:2])


def test_stops_by_held_out_rows_and_does_not_depend_on_partitions(table):
    options = dict(validation="held", row_id="id", rounds=12, leaves=31, step_size=0.9, patience=2, write_every=2)
    one = models.train_gbt_leaf(table, FEATURES, **options)
    assert 1 <= len(one.trees) == int(np.argmin(one.losses)) + 1 < 12
    assert len(one.losses) <= len(one.trees) + 2
    other = models.train_gbt_leaf(table.repartition(7, "b"), FEATURES, **options)
    assert [n[:7] for n in one.nodes()] == [n[:7] for n in other.nodes()]
    assert [n[7] for n in one.nodes()] == pytest.approx([n[7] for n in other.nodes()], rel=1e-9)


def test_save_load_and_score(spark, table, rows, tmp_path):
    x, _ = rows
    model = models.train_gbt_leaf(table, FEATURES, row_id="id", rounds=3)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = LeafwiseModel.load(spark, str(tmp_path / "m"))
    assert loaded.nodes() == model.nodes()
    scored = models.score_batch(table.withColumn("a", F.when(F.col("id") != 7, F.col("a"))), {"m": loaded}, FEATURES, "m")
    got = {r["id"]: r["predicted_ctr"] for r in scored.collect()}
    assert got.pop(7) is None
    want = 1 / (1 + np.exp(-model.margin(x)))
    assert all(abs(p - want[i]) < 1e-12 for i, p in got.items())
    both = model.transform(models.assemble(table, FEATURES)).select(vector_to_array("probability").alias("p"), "prediction")
    assert all(abs(sum(r["p"]) - 1) < 1e-12 and r["prediction"] == float(r["p"][1] > 0.5) for r in both.collect())


def test_one_class_and_constant_features(spark):
    df = spark.createDataFrame([(i, 1.0, float(i % 2), 0) for i in range(50)], "id long, a double, b double, clicked int")
    model = models.train_gbt_leaf(df, ["a", "b"], row_id="id", rounds=2)
    assert all(n.left < 0 for t in model.trees for n in t) or model.base < -10
    assert (model.margin(np.zeros((1, 2))) < -10).all()
