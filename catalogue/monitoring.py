"""Monitoring: last-n statistics, drift, health, series."""

from __future__ import annotations

from pyspark.sql import functions as F

import fixtures as fx
from adlens.operators import monitor
from catalogue import Catalogue, rounded

catalogue = Catalogue()
case = catalogue.case

_LATEST = "row_number() OVER (PARTITION BY model_name ORDER BY timestamp DESC, request_id DESC)"
_STATS = f"""SELECT model_name, avg(latency_ms) AS avg_latency_ms, quantile_cont(latency_ms, 0.5) AS p50_latency_ms,
  quantile_cont(latency_ms, 0.95) AS p95_latency_ms, quantile_cont(latency_ms, 0.99) AS p99_latency_ms,
  min(latency_ms) AS min_latency_ms, max(latency_ms) AS max_latency_ms
FROM (SELECT *, {_LATEST} AS r FROM predictions WHERE NOT error) WHERE r <= {{n}} GROUP BY model_name"""
_RATE = f"""SELECT model_name, CASE WHEN count(*) > 1 AND max(timestamp) > min(timestamp)
  THEN count(*) / ((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6 / 60) ELSE 0 END AS requests_per_minute
FROM (SELECT *, {_LATEST} AS r FROM predictions) WHERE r <= {{n}} GROUP BY model_name"""
_FIGURES = "avg_latency_ms p50_latency_ms p95_latency_ms p99_latency_ms min_latency_ms max_latency_ms".split()


def _round(columns, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


@case("last_n_stats", f"SELECT model_name, {_round(_FIGURES)} FROM ({_STATS.format(n=2000)})", "predictions")
def _(spark, sf):
    return rounded(monitor.last_n_stats(fx.predictions(spark, sf), 2000))


@case("request_rate", f"SELECT model_name, round(requests_per_minute, 6) AS requests_per_minute FROM ({_RATE.format(n=1000)})", "predictions")
def _(spark, sf):
    return rounded(monitor.request_rate(fx.predictions(spark, sf)))


_MODEL_STATS = f"""WITH lat AS ({_STATS.format(n=10000)}), rate AS ({_RATE.format(n=1000)}),
tot AS (SELECT model_name, count(*) AS total_requests, count(*) FILTER (NOT error) AS successful_requests, count(*) FILTER (error) AS error_count,
  count(*) FILTER (error) * 100 / count(*) AS error_rate, max(timestamp) AS last_updated FROM predictions GROUP BY model_name),
stats AS (SELECT * FROM tot LEFT JOIN lat USING (model_name) LEFT JOIN rate USING (model_name))"""


@case(
    "model_stats",
    f"""{_MODEL_STATS} SELECT model_name, total_requests, successful_requests, error_count, round(error_rate, 6) AS error_rate, last_updated,
  {_round(_FIGURES)}, round(requests_per_minute, 6) AS requests_per_minute FROM stats""",
    "predictions",
)
def _(spark, sf):
    return rounded(monitor.model_stats(fx.predictions(spark, sf)))


_BASE = """base AS (SELECT model_name, avg(predicted_ctr) AS bm, stddev_pop(predicted_ctr) AS bs, avg(latency_ms) AS lm, stddev_pop(latency_ms) AS ls
  FROM baseline_rows WHERE NOT error GROUP BY model_name)"""
_CURRENT = f"""cur AS (SELECT model_name, count(*) AS n, avg(predicted_ctr) AS m, stddev_pop(predicted_ctr) AS s, avg(latency_ms) AS l, stddev_pop(latency_ms) AS ls_now
  FROM (SELECT *, {_LATEST} AS r FROM predictions WHERE NOT error) WHERE r <= 1000 GROUP BY model_name)"""


@case(
    "baseline_fit",
    f"""WITH {_BASE} SELECT model_name, round(bm, 6) AS baseline_mean, round(bs, 6) AS baseline_std, round(lm, 6) AS baseline_latency_mean,
  round(ls, 6) AS baseline_latency_std FROM base""",
    "baseline_rows",
)
def _(spark, sf):
    return rounded(monitor.baseline_fit(fx.baseline_rows(spark, sf)))


@case(
    "drift_window",
    f"""WITH {_CURRENT} SELECT model_name, n, round(m, 6) AS current_mean, round(s, 6) AS current_std, round(l, 6) AS current_latency_mean,
  round(ls_now, 6) AS current_latency_std FROM cur""",
    "predictions",
)
def _(spark, sf):
    return rounded(monitor.drift_window(fx.predictions(spark, sf)))


@case(
    "baseline_join",
    f"WITH {_CURRENT}, {_BASE} SELECT model_name, n, round(m, 6) AS current_mean, round(bm, 6) AS baseline_mean FROM cur LEFT JOIN base USING (model_name)",
    "predictions baseline_rows",
)
def _(spark, sf):
    joined = monitor.baseline_join(monitor.drift_window(fx.predictions(spark, sf)), monitor.baseline_fit(fx.baseline_rows(spark, sf)))
    return rounded(joined.select("model_name", "n", "current_mean", "baseline_mean"))


# A baseline narrowed on purpose, so that every kind of finding occurs.
_NARROW = "narrow AS (SELECT model_name, bm * 0.5 AS bm, bs * CASE model_name WHEN 'xgboost' THEN 0.1 ELSE 0.6 END AS bs, lm * 0.2 AS lm, ls * 0.2 AS ls FROM base)"
_FINDINGS = f"""WITH {_CURRENT}, {_BASE}, {_NARROW}, j AS (SELECT *, abs(m - bm) / bs AS z, s / bs AS ratio, abs(l - lm) / ls AS lz FROM cur JOIN narrow USING (model_name) WHERE n >= 100),
found AS (SELECT model_name, 'mean_shift' AS type, CASE WHEN z > 3 THEN 'high' ELSE 'medium' END AS severity, z AS score, bm AS baseline_value, m AS current_value FROM j WHERE bs > 0 AND z > 2
UNION ALL SELECT model_name, 'variance_change', CASE WHEN ratio > 2 OR ratio < 0.5 THEN 'high' ELSE 'medium' END, ratio, bs, s FROM j WHERE bs > 0 AND (ratio > 1.5 OR ratio < 0.67)
UNION ALL SELECT model_name, 'latency_anomaly', CASE WHEN lz > 3 THEN 'high' ELSE 'medium' END, lz, lm, l FROM j WHERE ls > 0 AND lz > 2)"""


def _narrow(spark, sf):
    return monitor.baseline_fit(fx.baseline_rows(spark, sf)).selectExpr(
        "model_name", "baseline_mean * 0.5D AS baseline_mean",
        "baseline_std * CASE model_name WHEN 'xgboost' THEN 0.1D ELSE 0.6D END AS baseline_std",
        "baseline_latency_mean * 0.2D AS baseline_latency_mean", "baseline_latency_std * 0.2D AS baseline_latency_std",
    )


@case(
    "drift",
    f"{_FINDINGS} SELECT model_name, type, severity, round(score, 5) AS score, round(baseline_value, 5) AS baseline_value, round(current_value, 5) AS current_value FROM found",
    "predictions baseline_rows",
)
def _(spark, sf):
    return rounded(monitor.drift(fx.predictions(spark, sf), _narrow(spark, sf)), 5)


@case(
    "drift_status",
    f"""{_FINDINGS} SELECT model_name, n, model_name IN (SELECT model_name FROM found) AS drift_detected,
  CASE WHEN n < 100 THEN 'Insufficient data for drift detection' END AS reason FROM cur""",
    "predictions baseline_rows",
)
def _(spark, sf):
    log = fx.predictions(spark, sf)
    current = monitor.drift_window(log)
    return monitor.drift_status(current, monitor.drift_findings(current, _narrow(spark, sf)))


_CENTS = "CAST(CAST(floor(floor(error_rate * 100 + 0.5) / 100) AS BIGINT) AS VARCHAR) || '.' || lpad(CAST(CAST(floor(error_rate * 100 + 0.5) AS BIGINT) % 100 AS VARCHAR), 2, '0')"


def _report(spark, sf, compat=False):
    log = fx.predictions(spark, sf)
    return monitor.health(monitor.model_stats(log), monitor.drift(log, _narrow(spark, sf)), compat)


_HEALTH = f"{_MODEL_STATS}, {_FINDINGS[5:]}, bad AS (SELECT DISTINCT model_name FROM found)"


@case(
    "health",
    f"""{_HEALTH} SELECT model_name, CASE WHEN error_rate > 5 OR avg_latency_ms > 1000 THEN 'degraded' WHEN model_name IN (SELECT model_name FROM bad) THEN 'warning' ELSE 'healthy' END AS status,
  total_requests, round(error_rate, 6) AS error_rate, round(avg_latency_ms, 6) AS avg_latency_ms, round(requests_per_minute, 6) AS requests_per_minute FROM stats""",
    "predictions baseline_rows",
)
def _(spark, sf):
    return rounded(_report(spark, sf).drop("alerts"))


@case(
    "health_compat",
    f"""{_HEALTH} SELECT model_name, CASE WHEN model_name IN (SELECT model_name FROM bad) THEN 'warning' WHEN error_rate > 5 OR avg_latency_ms > 1000 THEN 'degraded' ELSE 'healthy' END AS status FROM stats""",
    "predictions baseline_rows",
)
def _(spark, sf):
    return _report(spark, sf, compat=True).select("model_name", "status")


@case(
    "health_alerts",
    f"""{_HEALTH} SELECT model_name, 'high' AS severity, 'High error rate: ' || {_CENTS} || '%' AS message FROM stats WHERE error_rate > 5
UNION ALL SELECT model_name, 'medium', 'Model drift detected' FROM stats WHERE model_name IN (SELECT model_name FROM bad)""",
    "predictions baseline_rows",
)
def _(spark, sf):
    return monitor.health_alerts(_report(spark, sf))


@case(
    "overall_health",
    f"""{_HEALTH} SELECT CASE WHEN count(*) FILTER (error_rate > 5 OR avg_latency_ms > 1000) > 0 THEN 'degraded' WHEN (SELECT count(*) FROM bad) > 0 THEN 'warning' ELSE 'healthy' END AS status,
  count(*) AS models FROM stats""",
    "predictions baseline_rows",
)
def _(spark, sf):
    return monitor.overall_health(_report(spark, sf))


_COUNTED = """WITH c AS (SELECT *, count(*) OVER w AS step, count(*) FILTER (NOT error) OVER w AS good, coalesce(sum(latency_ms) FILTER (NOT error) OVER w, 0) AS lat
  FROM predictions WINDOW w AS (PARTITION BY model_name ORDER BY timestamp, request_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@case(
    "running_snapshots",
    f"""{_COUNTED} SELECT model_name, timestamp, step AS total_requests, good AS successful_requests, round((step - good) * 100 / step, 6) AS error_rate,
  round(CASE WHEN good > 0 THEN lat / good ELSE 0 END, 6) AS avg_latency_ms FROM c WHERE step % 50 = 0""",
    "predictions",
)
def _(spark, sf):
    return rounded(monitor.running_snapshots(fx.predictions(spark, sf), every=50))


@case(
    "metric_history",
    f"""{_COUNTED}, g AS (SELECT model_name, request_id, avg(latency_ms) OVER (PARTITION BY model_name ORDER BY timestamp, request_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) AS sliding,
    quantile_cont(latency_ms, 0.95) OVER (PARTITION BY model_name ORDER BY timestamp, request_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) AS high
  FROM predictions WHERE NOT error),
h AS (SELECT c.*, count(*) OVER w AS k, min(timestamp) OVER w AS first_ts, last_value(g.sliding IGNORE NULLS) OVER (PARTITION BY c.model_name ORDER BY timestamp, c.request_id) AS mean_latency,
    last_value(g.high IGNORE NULLS) OVER (PARTITION BY c.model_name ORDER BY timestamp, c.request_id) AS high_latency
  FROM c LEFT JOIN g ON g.request_id = c.request_id WINDOW w AS (PARTITION BY c.model_name ORDER BY timestamp, c.request_id ROWS BETWEEN 499 PRECEDING AND CURRENT ROW))
SELECT model_name, step, timestamp, (step - good) * 100 / step AS error_rate, round(coalesce(mean_latency, 0), 5) AS avg_latency_ms, round(coalesce(high_latency, 0), 5) AS p95_latency_ms,
  round(CASE WHEN k > 1 AND timestamp > first_ts THEN k / ((epoch_us(timestamp) - epoch_us(first_ts)) / 1e6 / 60) ELSE 0 END, 5) AS requests_per_minute FROM h WHERE step % 10 = 0""",
    "predictions",
)
def _(spark, sf):
    log = fx.predictions(spark, sf)
    series = monitor.metric_history(log, latency_window=1000, rate_window=500, segment_rows=2500)
    # The error rate is one division of integers: nothing to round.
    return series.withColumns({c: F.round(c, 5) for c in ("avg_latency_ms", "p95_latency_ms", "requests_per_minute")})


@case(
    "request_series",
    """SELECT model_name, row_number() OVER (PARTITION BY model_name ORDER BY timestamp, request_id) AS step, timestamp, latency_ms,
  CAST(error AS INT) AS error, predicted_ctr FROM predictions""",
    "predictions",
)
def _(spark, sf):
    return monitor.request_series(fx.predictions(spark, sf))
