"""Heavy keys from summaries against plain counts."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adlens.operators.heavy import Summary, heavy_hashes, heavy_keys


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 12), max_size=40), max_size=8), st.integers(1, 6))
def test_summary_never_overcounts_and_misses_little(batches, slots):
    summary, real = Summary(slots), Counter()
    for batch in batches:
        summary.add(np.array(batch, np.int64))
        real.update(batch)
    held = dict(zip(summary.keys.tolist(), summary.counts.tolist(), strict=True))
    assert len(held) <= slots
    for key, n in real.items():
        low = held.get(key, 0)
        assert n - sum(real.values()) / (slots + 1) <= low <= n


@pytest.mark.parametrize("limit", [50, 400, 5000])
def test_keys_equal_plain_counts(spark, limit):
    rng = np.random.default_rng(limit)
    n = 6000
    rows = [
        (None if i % 40 == 0 else ("big" if i % 3 == 0 else f"k{int(rng.integers(0, 3000))}"), int(rng.zipf(1.4)) % 10**6, float(i % 7))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "a string, b long, c double").repartition(6)
    got = heavy_keys(df, [["a"], ["b"], ["a", "c"]], limit)
    for own, pick in zip(got, (lambda r: r[:1], lambda r: r[1:2], lambda r: (r[0], r[2])), strict=True):
        real = Counter(pick(r) for r in rows if None not in pick(r))
        assert {tuple(r)[:-1]: r["_rows"] for r in own} == {k: m for k, m in real.items() if m > limit}
        assert [r["_rows"] for r in own] == sorted((r["_rows"] for r in own), reverse=True)


def test_only_hashes_of_heavy_keys_are_shuffled(spark):
    df = spark.range(200_000, numPartitions=8).selectExpr("CASE WHEN id % 4 = 0 THEN -1 ELSE id END AS user")
    found = heavy_hashes(df, [["user"]], 200_000, 20_000)
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert heavy_keys(df, [["user"]], 20_000)[0][0]["_rows"] == 50_000


def test_small_tables_are_only_counted(spark):
    assert heavy_keys(spark.range(10), [["id"], ["id"]], 10) == [[], []]
