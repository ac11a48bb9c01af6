"""Sliding percentiles, means and rates in segments, against a plain loop."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.operators import monitor, order_windows
from adlens.operators.order_windows import segments_with_history, sorted_windows

SCHEMA = "request_id bigint, model_name string, timestamp timestamp_ntz, latency_ms double, error boolean, predicted_ctr double"


def log(spark, rows):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(i, m, start + timedelta(milliseconds=t), v, e, 0.1) for i, (m, t, v, e) in enumerate(rows)], SCHEMA
    ).repartition(5, "latency_ms")


def some_rows(n=700, seed=3):
    rng = random.Random(seed)
    out, at = [], 0
    for i in range(n):
        at += rng.choice([0, 0, 40, 1000])
        model = rng.choice(["hot", "hot", "hot", "cold", None])
        # A long run of errors in the middle: the successes a window needs lie many segments back.
        bad = 250 <= i < 450 or rng.random() < 0.2
        out.append((model, at, rng.choice([None, *map(float, range(30))]) if not bad else float(i), bad))
    return out


def plain(rows, every, latency_window, rate_window):
    out = {}
    by: dict = {}
    for i, (m, t, v, e) in enumerate(rows):
        if m is not None:
            by.setdefault(m, []).append((t, i, v, e))
    for m, own in by.items():
        own.sort()
        for k in range(every, len(own) + 1, every):
            seen = own[:k]
            good = [v for _, _, v, e in seen if not e and v is not None][-latency_window:]
            last = seen[-rate_window:]
            minutes = (last[-1][0] - last[0][0]) / 60_000
            out[m, k] = (
                sum(e for *_, e in seen) * 100 / k,
                np.mean(good) if good else 0.0,
                np.percentile(good, 95) if good else 0.0,
                len(last) / minutes if len(last) > 1 and minutes > 0 else 0.0,
            )
    return out


@pytest.mark.parametrize(("segment_rows", "hot_rows"), [(40, None), (64, 100), (100_000, None)])
def test_history_equals_a_plain_loop(spark, segment_rows, hot_rows):
    rows = some_rows()
    want = plain(rows, 5, 30, 20)
    got = monitor.metric_history(log(spark, rows), 5, 30, 20, hot_rows, segment_rows).collect()
    assert len(got) == len(want)
    for r in got:
        figures = (r["error_rate"], r["avg_latency_ms"], r["p95_latency_ms"], r["requests_per_minute"])
        assert figures == pytest.approx(want[r["model_name"], r["step"]])


def test_segments_are_bounded(spark):
    """However many errors lie between, a segment has its own rows and at most the two windows."""
    n = 2000
    df = spark.range(1, n + 1).select(
        F.lit("m").alias("k"), F.col("id").alias("step"), F.least(F.col("id"), F.lit(300)).alias("kept"), (F.col("id") <= 300).alias("is_kept")
    )
    sizes = segments_with_history(df, ["k"], 50, 100, 200).groupBy("_segment", "_use").count().collect()
    by = {(r["_segment"], r["_use"]): r["count"] for r in sizes}
    for s in range(10):
        assert by[s, order_windows.OWN] == 200
        assert by.get((s, order_windows.RECENT), 0) == (49 if s else 0)
        assert by.get((s, order_windows.KEPT), 0) == (100 if s else 0)


def test_sorted_window_with_ties():
    rng = np.random.default_rng(1)
    values, enters = rng.integers(0, 5, 300).astype(float), rng.random(300) < 0.7
    history = rng.integers(0, 5, 20).astype(float)
    got = sorted_windows(history, values, enters, np.ones(300, bool), 20, 0.95)
    for i in range(300):
        assert got[i] == pytest.approx(np.percentile([*history, *values[: i + 1][enters[: i + 1]]][-20:], 95))


def test_empty_log(spark):
    assert monitor.metric_history(log(spark, [("m", 0, 1.0, False)]).limit(0)).count() == 0
