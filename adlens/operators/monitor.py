"""Monitoring of the prediction log: request statistics, drift, health, metric history.

A log row is (model_name, timestamp, request_id, latency_ms, error, predicted_ctr).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlens.functions.temporal import seconds_between
from adlens.operators.order_windows import SEGMENT_ROWS, request_figures
from adlens.operators.ordered import last_n, running
from adlens.sources.materialise import materialise

MODEL = "model_name"
ORDER = ("timestamp", "request_id")

# Window sizes and limits.
LATENCY_WINDOW = 10_000
RATE_WINDOW = 1_000
DRIFT_WINDOW = 1_000
DRIFT_MINIMUM = 100
Z_LIMIT, Z_HIGH = 2.0, 3.0
RATIO_ABOVE, RATIO_BELOW = 1.5, 0.67
RATIO_HIGH_ABOVE, RATIO_HIGH_BELOW = 2.0, 0.5
ERROR_PCT_LIMIT = 5.0
LATENCY_LIMIT_MS = 1000.0


def last_n_stats(log: DataFrame, n: int = LATENCY_WINDOW, prune: bool = True) -> DataFrame:
    """Latency figures over each model's last `n` successful requests."""
    recent = last_n(log.filter(~F.col("error")), [MODEL], ORDER, n, prune=prune)
    v = F.col("latency_ms")
    # Size bound: a group holds at most n rows, so its exact percentiles fit a task.
    return recent.groupBy(MODEL).agg(
        F.avg(v).alias("avg_latency_ms"),
        F.percentile(v, F.lit(0.5)).alias("p50_latency_ms"),
        F.percentile(v, F.lit(0.95)).alias("p95_latency_ms"),
        F.percentile(v, F.lit(0.99)).alias("p99_latency_ms"),
        F.min(v).alias("min_latency_ms"),
        F.max(v).alias("max_latency_ms"),
    )


def _per_minute(rows: Column, seconds: Column) -> Column:
    return F.when((rows > 1) & (seconds > 0), rows / (seconds / 60)).otherwise(0.0)


def request_rate(log: DataFrame, n: int = RATE_WINDOW, prune: bool = True) -> DataFrame:
    """Requests per minute over each model's last `n` requests."""
    recent = last_n(log.select(MODEL, *ORDER), [MODEL], ORDER, n, prune=prune)
    spanned = recent.groupBy(MODEL).agg(
        F.count(F.lit(1)).alias("_n"),
        seconds_between(F.min("timestamp"), F.max("timestamp")).alias("_seconds"),
    )
    return spanned.select(MODEL, _per_minute(F.col("_n"), F.col("_seconds")).alias("requests_per_minute"))


def model_stats(log: DataFrame, latency_window: int = LATENCY_WINDOW, rate_window: int = RATE_WINDOW) -> DataFrame:
    """Counters, error percentage, latency figures and rate per model.

    The log is read twice: once for counts by model and hour, which give the counters and the hours that the windows
    reach back to, and once for the rows of those hours.
    """
    hour = F.timestamp_diff("HOUR", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("timestamp"))
    marked = log.select(MODEL, *ORDER, "latency_ms", "error", F.coalesce(hour, F.lit(-(10**9))).alias("_hour"))
    cells = materialise(
        marked.groupBy(MODEL, "_hour").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("error")).alias("good"),
            F.count_if("error").alias("bad"), F.max("timestamp").alias("last"),
        ),
        "hours",
    )
    totals = cells.groupBy(MODEL).agg(
        F.sum("rows").alias("total_requests"),
        F.sum("good").alias("successful_requests"),
        F.sum("bad").alias("error_count"),
        (F.sum("bad") * 100 / F.sum("rows")).alias("error_rate"),
        F.max("last").alias("last_updated"),
    )
    later = W.partitionBy(MODEL).orderBy(F.desc("_hour")).rowsBetween(W.unboundedPreceding, -1)
    reached = [F.coalesce(F.sum(c).over(later), F.lit(0)) < n for c, n in (("rows", rate_window), ("good", latency_window))]
    needed = cells.withColumn("_reached", reached[0] | reached[1]).filter("_reached")
    since = materialise(needed.groupBy(F.col(MODEL).alias("_model")).agg(F.min("_hour").alias("_since")), "since")
    mine = F.col(MODEL).eqNullSafe(F.col("_model")) & (F.col("_hour") >= F.col("_since"))
    recent = materialise(marked.join(since, mine).select(MODEL, *ORDER, "latency_ms", "error"), "recent")
    return totals.join(last_n_stats(recent, latency_window, prune=False), MODEL, "left").join(
        request_rate(recent, rate_window, prune=False), MODEL, "left"
    )


def baseline_fit(log: DataFrame) -> DataFrame:
    """Mean and population deviation of predictions and latencies per model."""
    ok = log.filter(~F.col("error") & F.col("predicted_ctr").isNotNull())
    return ok.groupBy(MODEL).agg(
        F.avg("predicted_ctr").alias("baseline_mean"),
        F.stddev_pop("predicted_ctr").alias("baseline_std"),
        F.avg("latency_ms").alias("baseline_latency_mean"),
        F.stddev_pop("latency_ms").alias("baseline_latency_std"),
    )


def drift_window(log: DataFrame, n: int = DRIFT_WINDOW) -> DataFrame:
    """Current statistics over each model's last `n` successful predictions."""
    ok = log.filter(~F.col("error") & F.col("predicted_ctr").isNotNull())
    return current_stats(last_n(ok, [MODEL], ORDER, n))


def current_stats(rows: DataFrame) -> DataFrame:
    return rows.groupBy(MODEL).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("predicted_ctr").alias("current_mean"),
        F.stddev_pop("predicted_ctr").alias("current_std"),
        F.avg("latency_ms").alias("current_latency_mean"),
        F.stddev_pop("latency_ms").alias("current_latency_std"),
    )


def drift_findings(
    current: DataFrame,
    baseline: DataFrame,
    threshold: float = Z_LIMIT,
    minimum: int = DRIFT_MINIMUM,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per deviation found: type, severity, score, baseline and current value."""
    rows = current.join(baseline, MODEL).filter(F.col("n") >= minimum)

    def finding(kind: str, found: Column, high: Column, score: Column, base: str, now: str) -> Column:
        return F.when(
            found,
            F.struct(
                F.lit(kind).alias("type"),
                F.when(high, "high").otherwise("medium").alias("severity"),
                score.alias("score"),
                F.col(base).alias("baseline_value"),
                F.col(now).alias("current_value"),
            ),
        )

    def shift(kind: str, mean: str, std: str, now: str) -> Column:
        z = F.try_divide(F.abs(F.col(now) - F.col(mean)), F.col(std))
        return finding(kind, (F.col(std) > 0) & (z > threshold), z > Z_HIGH, z, mean, now)

    ratio = F.try_divide(F.col("current_std"), F.col("baseline_std"))
    spread = finding(
        "variance_change",
        (F.col("baseline_std") > 0) & ((ratio > RATIO_ABOVE) | (ratio < RATIO_BELOW)),
        (ratio > RATIO_HIGH_ABOVE) | (ratio < RATIO_HIGH_BELOW),
        ratio,
        "baseline_std",
        "current_std",
    )
    found = F.array_compact(
        F.array(
            shift("mean_shift", "baseline_mean", "baseline_std", "current_mean"),
            spread,
            shift("latency_anomaly", "baseline_latency_mean", "baseline_latency_std", "current_latency_mean"),
        )
    )
    return rows.select(MODEL, *keep, F.inline(found))


def drift_status(current: DataFrame, findings: DataFrame, minimum: int = DRIFT_MINIMUM) -> DataFrame:
    """Whether each model drifted, or why that cannot be told."""
    per = findings.groupBy(MODEL).agg(F.count(F.lit(1)).alias("_found"))
    return current.join(per, MODEL, "left").select(
        MODEL,
        "n",
        F.coalesce(F.col("_found") > 0, F.lit(False)).alias("drift_detected"),
        F.when(F.col("n") < minimum, "Insufficient data for drift detection").alias("reason"),
    )


def drift(log: DataFrame, baseline: DataFrame, n: int = DRIFT_WINDOW) -> DataFrame:
    return drift_findings(drift_window(log, n), baseline)


def _alert(found: Column, severity: str, message: Column) -> Column:
    return F.when(
        found, F.struct(F.lit(severity).alias("severity"), message.alias("message"))
    )


def health(
    stats: DataFrame, drifted: DataFrame, compat: bool = False, keys: Sequence[str] = (MODEL,)
) -> DataFrame:
    """Status per model with its alerts. `drifted` holds the models with drift.

    With `compat` drift turns a degraded model into a warning; otherwise
    the worse status stays.
    """
    marks = drifted.select(*keys).distinct().withColumn("_drift", F.lit(True))
    rows = stats.join(marks, list(keys), "left")
    is_drift = F.coalesce("_drift", F.lit(False))
    errors = F.col("error_rate") > ERROR_PCT_LIMIT
    slow = F.coalesce(F.col("avg_latency_ms") > LATENCY_LIMIT_MS, F.lit(False))
    degraded = errors | slow
    if compat:
        status = F.when(is_drift, "warning").when(degraded, "degraded")
    else:
        status = F.when(degraded, "degraded").when(is_drift, "warning")

    def two_decimals(value: Column) -> Column:
        cents = F.floor(value * 100 + F.lit(0.5)).cast("bigint")
        return F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))

    alerts = F.array_compact(
        F.array(
            _alert(errors, "high", F.concat(F.lit("High error rate: "), two_decimals(F.col("error_rate")), F.lit("%"))),
            _alert(slow, "medium", F.concat(F.lit("High latency: "), two_decimals(F.col("avg_latency_ms")), F.lit("ms"))),
            _alert(is_drift, "medium", F.lit("Model drift detected")),
        )
    )
    return rows.select(
        *keys,
        status.otherwise("healthy").alias("status"),
        "total_requests",
        "error_rate",
        "avg_latency_ms",
        "requests_per_minute",
        alerts.alias("alerts"),
    )


def health_alerts(report: DataFrame) -> DataFrame:
    return report.select(MODEL, F.inline("alerts"))


def overall_health(report: DataFrame) -> DataFrame:
    """Degraded if any model is, else warning if any is, else healthy."""
    severity = F.when(F.col("status") == "degraded", 2).when(F.col("status") == "warning", 1).otherwise(0)
    worst = F.coalesce(F.max(severity), F.lit(0))
    return report.agg(
        F.element_at(F.array(F.lit("healthy"), F.lit("warning"), F.lit("degraded")), worst + 1).alias("status"),
        F.count(F.lit(1)).alias("models"),
    )


def running_snapshots(
    log: DataFrame, keys: Sequence[str] = (MODEL,), every: int = 10, hot_rows: int | None = None
) -> DataFrame:
    """Cumulative request, success, error and latency figures at every `every`-th request of a key."""
    ok = ~F.col("error")
    counted = running(
        log, keys, ORDER, inclusive=True, hot_rows=hot_rows,
        sums={
            "total_requests": F.lit(1),
            "successful_requests": ok.cast("int"),
            "_latency": F.when(ok, F.col("latency_ms")),
        },
    )
    n, good = F.col("total_requests"), F.col("successful_requests")
    return counted.filter(n % every == 0).select(
        *keys,
        "timestamp",
        "total_requests",
        "successful_requests",
        ((n - good) * 100 / n).alias("error_rate"),
        F.coalesce(F.try_divide("_latency", good), F.lit(0.0)).alias("avg_latency_ms"),
    )


def metric_history(
    log: DataFrame,
    every: int = 10,
    latency_window: int = LATENCY_WINDOW,
    rate_window: int = RATE_WINDOW,
    hot_rows: int | None = None,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """The series a monitor reports: at every `every`-th request, error percentage so far, mean and 95th
    percentile latency of the last successes and requests per minute over the last requests.

    Requests are numbered once and written; the windows are then computed in segments of bounded size. A success
    without a latency is no part of the latency window; a request without a model belongs to no series.
    """
    ok = ~F.col("error")
    timed = ok & F.col("latency_ms").isNotNull()
    counted = running(
        log.filter(F.col(MODEL).isNotNull()).select(MODEL, *ORDER, "latency_ms", "error"),
        [MODEL], ORDER, inclusive=True, hot_rows=hot_rows,
        sums={"step": F.lit(1), "_good": ok.cast("int"), "kept": timed.cast("int")},
    )
    rows = materialise(
        counted.select(MODEL, "timestamp", "step", "_good", "kept", timed.alias("is_kept"), "latency_ms"), "numbered"
    )
    figures = request_figures(rows, [MODEL], every, latency_window, rate_window, segment_rows=segment_rows)
    step, good = F.col("step"), F.col("_good")
    shots = rows.filter(step % every == 0).select(MODEL, "step", "timestamp", ((step - good) * 100 / step).alias("error_rate"))
    return shots.join(figures, [MODEL, "step"]).select(
        MODEL, "step", "timestamp", "error_rate", "avg_latency_ms", "p95_latency_ms", "requests_per_minute"
    )


def request_series(log: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Latency, error flag and prediction of every request, numbered per model."""
    counted = running(log, [MODEL], ORDER, sums={"step": F.lit(1)}, inclusive=True, hot_rows=hot_rows)
    return counted.select(
        MODEL, "step", "timestamp", "latency_ms", F.col("error").cast("int").alias("error"), "predicted_ctr"
    )


def attach_feedback(predictions: DataFrame, feedback: DataFrame, key: str = "request_id") -> DataFrame:
    """Actual outcomes joined to predictions by request id; without feedback the outcome is null."""
    columns = [c for c in predictions.columns if c != "actual_ctr"]
    return predictions.select(*columns).join(feedback.select(key, "actual_ctr"), key, "left")


def baseline_join(current: DataFrame, baseline: DataFrame) -> DataFrame:
    return current.join(baseline, MODEL, "left")


