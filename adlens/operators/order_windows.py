"""Order statistics over sliding windows, in tasks of bounded size.

A window of the last 10,000 successes has no running form: its percentile at each step needs the window itself.
Rows are numbered per key once and cut by that number into segments of equal length. Each segment gets, beside its
own rows, the rows before it that its first windows still reach - by position for a window over requests, by the
count of successes for a window over successes, which may lie any number of segments back. A segment is then
computed by itself: a sorted list takes each success in and lets the one that leaves the window out.

No task holds more than a segment and its windows, however heavy a key is, and all sums are sums over a segment, so
they lose no digits over the life of a key.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT_ROWS = 100_000
#: Why a row is in a segment: it belongs there, a window over rows reaches it, a window over successes does.
OWN, RECENT, KEPT = 1, 2, 4


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def _instant(micros: str) -> Column:
    return F.timestamp_add("MICROSECOND", F.col(micros), F.lit("1970-01-01").cast("timestamp_ntz"))


def segments_with_history(
    numbered: DataFrame, keys: Sequence[str], row_window: int, kept_window: int, segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Every row in its own segment (`_use` OWN) and once more in each later one whose windows reach it.

    `numbered` has `step` (1, 2, ... per key), `kept` (how many rows so far are in the second kind of window) and
    the boolean `is_kept`. A segment gets fewer than `row_window` RECENT and at most `kept_window` KEPT rows.
    """
    own = numbered.withColumn("_segment", F.expr(f"(step - 1) div {segment_rows}"))
    columns = [c for c in own.columns if c != "_segment"]
    last = F.expr(f"(step + {row_window - 2}) div {segment_rows}")
    recent = own.filter(last > F.col("_segment")).select(
        *columns, F.explode(F.sequence(F.col("_segment") + 1, last)).alias("_segment")
    )
    # How many kept rows lie before each segment; the ones a segment needs are in at most two buckets of them.
    before = (
        own.groupBy(*keys, "_segment")
        .agg(F.min(F.col("kept") - F.col("is_kept").cast("int")).alias("_before"))
        .filter("_before > 0")
    )
    low, high = F.expr(f"greatest(_before - {kept_window}, 0) div {kept_window}"), F.expr(f"(_before - 1) div {kept_window}")
    wanted = before.select(*keys, "_segment", "_before", F.explode(F.sequence(low, high)).alias("_bucket"))
    kept = (
        numbered.filter("is_kept")
        .withColumn("_bucket", F.expr(f"(kept - 1) div {kept_window}"))
        .join(wanted, [*keys, "_bucket"])
        .filter((F.col("kept") <= F.col("_before")) & (F.col("kept") > F.col("_before") - kept_window))
        .select(*columns, "_segment")
    )
    # A segment beyond the last row of a key has nothing of its own to compute.
    ends = numbered.groupBy(*keys).agg(F.expr(f"(max(step) - 1) div {segment_rows}").alias("_last"))
    recent = recent.join(ends, list(keys)).filter("_segment <= _last").drop("_last")
    return (
        own.withColumn("_use", F.lit(OWN))
        .unionByName(recent.withColumn("_use", F.lit(RECENT)))
        .unionByName(kept.withColumn("_use", F.lit(KEPT)))
    )


def sorted_windows(history: np.ndarray, values: np.ndarray, enters: np.ndarray, asked: np.ndarray, window: int, p: float) -> np.ndarray:
    """Linear-interpolated quantile of the last `window` entered values at each asked position; NaN while there are none."""
    ring = sorted(history.tolist())
    queue = [*history.tolist(), *values[enters].tolist()]
    out = np.full(len(values), np.nan)
    inside = len(history)
    for i in np.flatnonzero(enters | asked).tolist():
        if enters[i]:
            insort(ring, queue[inside])
            inside += 1
            if len(ring) > window:
                del ring[bisect_left(ring, queue[inside - 1 - window])]
        if asked[i] and ring:
            at = p * (len(ring) - 1)
            low = int(at)
            up = ring[min(low + 1, len(ring) - 1)]
            out[i] = ring[low] + (up - ring[low]) * (at - low)
    return out


def request_figures(
    numbered: DataFrame,
    keys: Sequence[str],
    every: int,
    latency_window: int,
    rate_window: int,
    quantile: float = 0.95,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """At every `every`-th step: mean and quantile of the last `latency_window` kept latencies, and requests a minute
    over the last `rate_window` rows.

    `numbered` has the keys, `step`, `timestamp`, `kept`, `is_kept` and `latency_ms`. Without kept rows the mean and
    the quantile are 0; a rate of one row, or of no time, is 0.
    """
    rows = numbered.select(
        *keys, "step", "kept", F.coalesce("is_kept", F.lit(False)).alias("is_kept"),
        _micros(F.col("timestamp")).alias("at"), F.col("latency_ms").cast("double").alias("latency"),
    )
    together = segments_with_history(rows, keys, rate_window, latency_window, segment_rows)

    def figures(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        own = frame[frame["_use"] == OWN].sort_values("step")
        past = frame[frame["_use"] == KEPT].sort_values("kept")["latency"].to_numpy()
        times = np.concatenate([frame[frame["_use"] == RECENT].sort_values("step")["at"].to_numpy(float), own["at"].to_numpy(float)])
        steps, enters, values = own["step"].to_numpy(), own["is_kept"].to_numpy(bool), own["latency"].to_numpy()
        asked = steps % every == 0
        until = len(past) + np.cumsum(enters)
        since = np.maximum(until - latency_window, 0)
        sums = np.concatenate([[0.0], np.cumsum(np.concatenate([past, values[enters]]))])
        here = np.arange(len(times) - len(own), len(times))
        start = np.maximum(here + 1 - rate_window, 0)
        minutes, n = (times[here] - times[start]) / 6e7, here + 1 - start
        out = pd.DataFrame(dict(zip(keys, key, strict=False)), index=range(len(own)))
        out["step"] = steps
        with np.errstate(divide="ignore", invalid="ignore"):
            out["avg_latency_ms"] = np.where(until > 0, (sums[until] - sums[since]) / (until - since), 0.0)
            out["requests_per_minute"] = np.where((n > 1) & (minutes > 0), n / minutes, 0.0)
        out["p95_latency_ms"] = np.nan_to_num(sorted_windows(past, values, enters, asked, latency_window, quantile))
        return out[asked]

    types = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{types}, step long, avg_latency_ms double, requests_per_minute double, p95_latency_ms double"
    return together.groupBy(*keys, "_segment").applyInPandas(figures, schema)
