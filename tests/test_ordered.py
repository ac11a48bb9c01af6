from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows on one key, a third on a second, some keys small, some rows without key."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = None if i % 50 == 0 else "hot" if i % 2 else "warm" if i % 3 else f"k{rng.randrange(40)}"
        rows.append((i, key, rng.randrange(300), rng.choice([0, 1, None]), rng.choice(["x", "y", None])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id int, key string, at int, y int, tag string").cache()


def computed(df, **options):
    out = ordered.running(
        df, ["key"], ["at", "id"],
        sums={"s": F.col("y"), "n": F.lit(1)},
        lasts={"last_tag": F.col("tag"), "last_at": F.col("at")},
        totals={"all_y": F.col("y")},
        **options,
    )
    return sorted(tuple(r) for r in out.select("id", "key", "s", "n", "last_tag", "last_at", "all_y").collect())


def expected(df, inclusive):
    out, by_key = [], {}
    for r in sorted(df.collect(), key=lambda r: (r["at"], r["id"])):
        by_key.setdefault(r["key"], []).append(r)
    for key, rows in by_key.items():
        for i, r in enumerate(rows):
            if key is None:
                out.append((r["id"], None, None, None, None, None, None))
                continue
            before = rows[: i + 1] if inclusive else rows[:i]
            tags = [b["tag"] for b in before if b["tag"]]
            out.append(
                (
                    r["id"], key, sum(b["y"] or 0 for b in before), len(before), tags[-1] if tags else None,
                    before[-1]["at"] if before else None, sum(b["y"] or 0 for b in rows),
                )
            )
    return sorted(out)


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("hot_rows", [None, 700, 100, 25])
def test_running_is_the_same_on_every_path(skewed, inclusive, hot_rows):
    assert computed(skewed, inclusive=inclusive, hot_rows=hot_rows) == expected(skewed, inclusive)


def test_hot_keys_are_found_heaviest_first(skewed):
    found = ordered.hot_keys(skewed, ["key"], 700)
    assert [r["key"] for r in found] == ["hot", "warm"]
    many = ordered.hot_values(skewed, ["key", "at"], 700)
    assert [r["key"] for r in many["key"]] == ["hot", "warm"] and many["at"] == []


def test_hot_values_keep_the_column_type(skewed):
    assert all(isinstance(r["at"], int) for r in ordered.hot_values(skewed, ["at"], 12)["at"])


def test_segments_share_the_rows_of_a_hot_key(spark):
    one = spark.range(4000).select(F.lit("only").alias("key"), "id")
    out = ordered._running_segmented(one, ["key"], ["id"], {"n": F.lit(1)}, {}, {}, False, 8)
    assert [r["n"] for r in out.orderBy("id").collect()] == list(range(4000))
    rows = ordered.materialise(one.repartitionByRange(8, "key", "id").withColumn("s", F.spark_partition_id()), "t")
    assert rows.groupBy("s").count().agg(F.max("count")).first()[0] < 1500


@pytest.mark.parametrize("lanes", [1, 3, 256])
def test_last_n(skewed, lanes):
    got = ordered.last_n(skewed.filter("key IS NOT NULL").repartition(5), ["key"], ["at", "id"], 7, lanes)
    want = {}
    for r in sorted(skewed.filter("key IS NOT NULL").collect(), key=lambda r: (r["at"], r["id"])):
        want.setdefault(r["key"], []).append(r["id"])
    assert sorted((r["key"], r["id"]) for r in got.collect()) == sorted((k, i) for k, v in want.items() for i in v[-7:])


def test_last_n_reads_only_the_hours_it_needs(spark):
    df = spark.range(5000).select(
        (F.col("id") % 2).alias("key"), F.col("id"),
        F.expr("CASE WHEN id < 10 THEN TIMESTAMP_NTZ '1969-12-31 22:30:00' ELSE timestampadd(MINUTE, CAST(id AS INT), TIMESTAMP_NTZ '2024-01-01') END").alias("ts"),
    )
    got = ordered.last_n(df, ["key"], ["ts", "id"], 45)
    assert sorted(r["id"] for r in got.collect()) == list(range(4910, 5000))
    assert ordered._recent_hours(df, ["key"], "ts", 45).count() <= 150
    assert ordered.last_n(df, ["key"], ["ts", "id"], 10_000).count() == 5000


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_exact_quantiles_follow_linear_interpolation(spark, hot_rows):
    rng = random.Random(3)
    rows = [(g, round(rng.expovariate(1), 2)) for g in ("a", "b") for _ in range(500)] + [("c", 4.0), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = ordered.exact_quantiles(df, ["g"], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}, hot_rows)
    got = {r["g"]: (r["p10"], r["p50"], r["p99"]) for r in got.collect()}
    for g in ("a", "b", "c"):
        assert got[g] == pytest.approx(np.percentile([v for k, v in rows if k == g], [10, 50, 99]))
    assert "d" not in got
