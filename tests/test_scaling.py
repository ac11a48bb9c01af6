"""What bounds the rows of a task, and what repeats no step."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlens.operators import history, leafwise, models, ordered
from adlens.operators.leafwise import Node
from adlens.plans.feature_table import FeatureOptions, basic_features


@pytest.fixture
def log(spark):
    return spark.range(400).selectExpr(
        "id AS impression_id", "id % 37 AS user_id", "id % 11 AS ad_id", "IF(id % 4 = 0, 'tablet', 'mobile') AS device",
        "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, CAST(id * 7 % 90 AS INT)) AS timestamp",
        "CAST(id % 24 AS INT) AS hour", "CAST(id % 3 = 0 AS INT) AS clicked",
    )


def test_a_key_that_one_task_should_not_sort_is_heavy(spark):
    rows = spark.range(600_000).select(F.lit("mobile").alias("device"))
    assert [r["device"] for r in ordered.hot_keys(rows, ["device"])] == ["mobile"]


def test_written_rows_of_heavy_keys_carry_no_features_of_other_keys(log, monkeypatch):
    written = []
    keep = ordered.materialise
    monkeypatch.setattr(ordered, "materialise", lambda df, name: written.append(df.columns) or keep(df, name))
    plain = basic_features(log, FeatureOptions())
    assert not written
    heavy = basic_features(log, FeatureOptions(hot_rows=60))
    assert written and not [c for columns in written for c in columns if "user_id_" in c or "ad_id_" in c]
    assert heavy.columns == plain.columns
    assert sorted(map(str, heavy.collect())) == sorted(map(str, plain.collect()))


def test_histories_of_several_keys_equal_one_after_the_other(log):
    keys = {"user_id": "_user", "device": "_device"}
    one = log
    for key, suffix in keys.items():
        one = history.history_features(one, key, suffix)
    for hot_rows in (None, 60):
        out = history.histories(log, keys, hot_rows=hot_rows)
        assert out.columns == one.columns
        assert sorted(map(str, out.collect())) == sorted(map(str, one.collect()))


def test_a_fit_reads_even_partitions(spark, monkeypatch):
    monkeypatch.setattr(models, "FIT_ROWS", 100)
    seen = []
    keep = models.GBTClassifier.fit
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, df: seen.append(df.groupBy(F.spark_partition_id()).count().collect()) or keep(self, df))
    rows = spark.range(1000).selectExpr("CAST(id % 7 AS DOUBLE) AS x", "CAST(id % 3 = 0 AS INT) AS clicked").coalesce(1)
    models.train_gbt(rows, ["x"], rounds=1, max_depth=2)
    counts = [r["count"] for r in seen[0]]
    assert sum(counts) == 1000 and len(counts) == 10 and max(counts) <= 110


def grown(rng, leaves, width):
    nodes = [Node(0, 0.0, 0.0, 0.0)]
    for _ in range(leaves - 1):
        k = int(rng.choice([i for i, n in enumerate(nodes) if n.left < 0]))
        nodes[k].feature, nodes[k].bin = int(rng.integers(width)), int(rng.integers(256))
        nodes[k].left, nodes[k].right = len(nodes), len(nodes) + 1
        nodes += [Node(0, 0.0, 0.0, 0.0), Node(0, 0.0, 0.0, 0.0)]
    return nodes


@pytest.mark.parametrize("leaves", [1, 2, 31, 64, 65, 150])
def test_leaves_by_tables_equal_leaves_by_walking(leaves):
    rng = np.random.default_rng(leaves)
    nodes, bins = grown(rng, leaves, 4), rng.integers(0, 256, (3000, 4)).astype(np.uint8)
    at = leafwise.routes(leafwise.shape_of(nodes), bins)
    every = [k for k, n in enumerate(nodes) if n.left < 0]
    for wanted in (every, every[::2]):
        place = {k: i for i, k in enumerate(wanted)}
        found = leafwise.reached(leafwise.reach_tables(nodes, wanted), bins.T, len(bins))
        assert found.tolist() == [place.get(k, -1) for k in at.tolist()]


def test_records_of_rows_give_their_values_back():
    values = np.arange(11, dtype=float)
    batch = pa.RecordBatch.from_arrays([leafwise.blocked(values, np.array([4, 4, 3]))], ["margin"])
    assert leafwise.unblocked(batch, "margin").tolist() == values.tolist()
    assert leafwise.unblocked(batch.slice(1, 2), "margin").tolist() == values[4:].tolist()
