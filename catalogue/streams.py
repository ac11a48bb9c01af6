"""Streaming jobs, drained over the given events, against their batch meaning."""

from __future__ import annotations

from pyspark.sql import functions as F

import fixtures as fx
from adlens.operators import monitor
from adlens.streaming import jobs
from catalogue import Catalogue, rounded, scratch

catalogue = Catalogue()
case = catalogue.case


def events_stream(spark, sf):
    schema = fx.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def log_stream(spark, sf):
    return fx.predictions_of(events_stream(spark, sf))


# A window is final once the watermark, which trails the newest event, has passed its end.
_MARK = "(SELECT date_trunc('millisecond', max(timestamp)) - INTERVAL 10 MINUTE FROM predictions)"


@case(
    "stream_predictions",
    "SELECT request_id, model_name, predicted_ctr, actual_ctr, timestamp, CAST(timestamp AS DATE) AS date FROM predictions",
    "predictions",
)
def _(spark, sf):
    path = scratch(spark, "stream")
    jobs.stream_predictions(log_stream(spark, sf), f"{path}/rows", f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{path}/rows").select("request_id", "model_name", "predicted_ctr", "actual_ctr", "timestamp", "date")


@case(
    "stream_model_stats",
    f"""SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, model_name,
  count(*) AS total_requests, count(*) FILTER (NOT error) AS successful_requests, count(*) FILTER (error) AS error_count,
  round(count(*) FILTER (error) * 100 / count(*), 6) AS error_rate, round(avg(latency_ms) FILTER (NOT error), 6) AS avg_latency_ms,
  min(latency_ms) FILTER (NOT error) AS min_latency_ms, max(latency_ms) FILTER (NOT error) AS max_latency_ms,
  round(count(*) / 60, 6) AS requests_per_minute
FROM (SELECT *, date_trunc('hour', timestamp) AS window_start FROM predictions) WHERE window_start + INTERVAL 1 HOUR <= {_MARK} GROUP BY window_start, model_name""",
    "predictions",
)
def _(spark, sf):
    out = jobs.drain(jobs.stream_model_stats(log_stream(spark, sf)))
    return rounded(
        out.select(
            "window_start", "window_end", "model_name", "total_requests", "successful_requests", "error_count", "error_rate",
            "avg_latency_ms", "min_latency_ms", "max_latency_ms", "requests_per_minute",
        )
    )


@case(
    "stream_sliding_rate",
    f"""WITH w AS (SELECT model_name, date_trunc('minute', timestamp) - to_minutes(k) AS window_start FROM predictions, range(5) t(k))
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, model_name, count(*) AS requests, round(count(*) / 5, 6) AS requests_per_minute
FROM w GROUP BY ALL HAVING window_start + INTERVAL 5 MINUTE <= {_MARK}""",
    "predictions",
)
def _(spark, sf):
    return rounded(jobs.drain(jobs.stream_sliding_rate(log_stream(spark, sf))))


@case(
    "stream_ab_metrics",
    f"""WITH a AS (SELECT r.*, CASE WHEN t.model_a IS NULL THEN NULL WHEN t.enabled AND NOT coalesce(r.timestamp > t.end_time, false) AND
    {fx.sql_md5_mod("r.test_id || ':' || r.user_id", 10000)} / 10000.0::DOUBLE < t.traffic_split THEN t.model_b ELSE t.model_a END AS model_name
  FROM ab_requests r LEFT JOIN ab_tests t USING (test_id))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, test_id, model_name,
  count(*) AS total_requests, count(*) FILTER (NOT error) AS total_predictions, round(avg(latency_ms) FILTER (NOT error), 6) AS avg_prediction_time_ms,
  count(*) FILTER (error) AS error_count FROM (SELECT *, date_trunc('hour', timestamp) AS window_start FROM a)
WHERE window_start + INTERVAL 1 HOUR <= {_MARK} GROUP BY window_start, test_id, model_name""",
    "ab_tests ab_requests",
)
def _(spark, sf):
    asked = log_stream(spark, sf).select(
        "request_id", F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("test_id"), "user_id", "latency_ms", "error", "timestamp"
    )
    return rounded(jobs.drain(jobs.stream_ab_metrics(asked, fx.ab_tests(spark, sf))))


def _findings_sql(current: str, columns: str) -> str:
    """Deviations of `current` (n, m, s, l) from a baseline whose prediction deviation is cut to 0.3."""
    return f"""WITH base AS (SELECT model_name, avg(predicted_ctr) AS bm, stddev_pop(predicted_ctr) * 0.3 AS bs, avg(latency_ms) AS lm, stddev_pop(latency_ms) AS ls
  FROM baseline_rows WHERE NOT error GROUP BY model_name),
cur AS ({current}),
j AS (SELECT *, abs(m - bm) / bs AS z, s / bs AS ratio, abs(l - lm) / ls AS lz FROM cur JOIN base USING (model_name))
SELECT {columns}, 'mean_shift' AS type, CASE WHEN z > 3 THEN 'high' ELSE 'medium' END AS severity, round(z, 5) AS score, round(bm, 5) AS baseline_value, round(m, 5) AS current_value FROM j WHERE z > 2
UNION ALL SELECT {columns}, 'variance_change', CASE WHEN ratio > 2 OR ratio < 0.5 THEN 'high' ELSE 'medium' END, round(ratio, 5), round(bs, 5), round(s, 5) FROM j WHERE ratio > 1.5 OR ratio < 0.67
UNION ALL SELECT {columns}, 'latency_anomaly', CASE WHEN lz > 3 THEN 'high' ELSE 'medium' END, round(lz, 5), round(lm, 5), round(l, 5) FROM j WHERE lz > 2"""


def _baseline(spark, sf):
    fitted = monitor.baseline_fit(fx.baseline_rows(spark, sf))
    return fitted.withColumn("baseline_std", F.col("baseline_std") * 0.3)


_FIGURES = "avg(predicted_ctr) AS m, stddev_pop(predicted_ctr) AS s, avg(latency_ms) AS l"


@case(
    "stream_drift",
    _findings_sql(
        f"""SELECT model_name, {_FIGURES} FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY timestamp DESC, request_id DESC) AS r
  FROM predictions WHERE NOT error) WHERE r <= 1000 GROUP BY model_name HAVING count(*) >= 100""",
        "model_name",
    ),
    "predictions baseline_rows",
)
def _(spark, sf):
    # Several micro-batches: the events in four files of neighbouring times, one file a batch.
    path = scratch(spark, "drift")
    events = fx.table(spark, sf, "events")
    events.repartitionByRange(4, "ts").write.parquet(f"{path}/events")
    files = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/events")
    baseline = _baseline(spark, sf)
    jobs.start_drift(fx.predictions_of(files), baseline, path, f"{path}/checkpoint", once=True).awaitTermination()
    return rounded(jobs.latest_findings(spark, path, baseline), 5)


@case(
    "stream_window_drift",
    _findings_sql(
        f"""SELECT window_start, model_name, {_FIGURES} FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, timestamp) AS window_start FROM predictions)
  WHERE NOT error AND window_start + INTERVAL 6 HOUR <= {_MARK} GROUP BY window_start, model_name HAVING count(*) >= 20""",
        "window_start, model_name",
    ),
    "predictions baseline_rows",
)
def _(spark, sf):
    stats = jobs.stream_model_stats(log_stream(spark, sf), window="6 hours")
    path = scratch(spark, "windows")
    jobs.start_parquet_sink(stats, f"{path}/rows", f"{path}/checkpoint", once=True).awaitTermination()
    windows = spark.read.schema(stats.schema).parquet(f"{path}/rows")
    return rounded(jobs.stream_window_drift(windows, _baseline(spark, sf), minimum=20), 5)


_TWO_DAYS = "time_bucket(INTERVAL 2 DAY, timestamp, TIMESTAMP '1970-01-01')"


def _cents(value):
    """A figure to two decimals, as text."""
    return f"CAST(CAST(floor(floor({value} * 100 + 0.5) / 100) AS BIGINT) AS VARCHAR) || '.' || lpad(CAST(CAST(floor({value} * 100 + 0.5) AS BIGINT) % 100 AS VARCHAR), 2, '0')"


@case(
    "stream_alerts",
    f"""WITH w AS (SELECT *, latency_ms * 3 AS slow_ms, {_TWO_DAYS} AS window_start FROM predictions),
st AS (SELECT window_start, model_name, count(*) FILTER (error) * 100 / count(*) AS error_rate, avg(slow_ms) FILTER (NOT error) AS latency
  FROM w WHERE window_start + INTERVAL 2 DAY <= {_MARK} GROUP BY ALL),
f AS ({_findings_sql(f"SELECT window_start, model_name, {_FIGURES.replace('latency_ms', 'slow_ms')} FROM w WHERE NOT error AND window_start + INTERVAL 2 DAY <= {_MARK} GROUP BY window_start, model_name HAVING count(*) >= 100", "window_start, model_name")})
SELECT window_start, model_name, 'high' AS severity, 'High error rate: ' || {_cents("error_rate")} || '%' AS message FROM st WHERE error_rate > 5
UNION ALL SELECT window_start, model_name, 'medium', 'High latency: ' || {_cents("latency")} || 'ms' FROM st WHERE latency > 1000
UNION ALL SELECT DISTINCT window_start, model_name, 'medium', 'Model drift detected' FROM f""",
    "predictions baseline_rows",
)
def _(spark, sf):
    """Latencies are tripled, so that windows are slow, and the baseline is narrow, so that they drift."""
    path = scratch(spark, "alerts")
    log = log_stream(spark, sf).withColumn("latency_ms", F.col("latency_ms") * 3)
    stats = jobs.stream_model_stats(log, window="2 days")
    jobs.start_alerts(stats, _baseline(spark, sf), f"{path}/alerts", f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{path}/alerts").select("window_start", "model_name", "severity", "message")


@case(
    "stream_feedback",
    f"""SELECT request_id, model_name, predicted_ctr, actual_ctr FROM predictions WHERE actual_ctr IS NOT NULL
UNION ALL SELECT request_id, model_name, predicted_ctr, NULL FROM predictions WHERE actual_ctr IS NULL
  AND date_trunc('millisecond', timestamp) + INTERVAL 30 MINUTE < {_MARK}""",
    "predictions",
)
def _(spark, sf):
    made = log_stream(spark, sf)
    seen = fx.predictions_of(events_stream(spark, sf)).filter("actual_ctr IS NOT NULL").select(
        "request_id", "actual_ctr", (F.col("timestamp") + F.expr("INTERVAL 1 MINUTE")).alias("timestamp")
    )
    out = jobs.drain(jobs.stream_feedback(made, seen, within="30 minutes"))
    return out.select("request_id", "model_name", "predicted_ctr", "actual_ctr")


@case(
    "stream_user_sessions",
    """WITH g AS (SELECT *, coalesce(timestamp >= lag(timestamp) OVER w + INTERVAL 30 MINUTE, true) AS opens FROM impressions WINDOW w AS (PARTITION BY user_id ORDER BY timestamp)),
n AS (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY user_id ORDER BY timestamp) AS session FROM g)
SELECT user_id, min(timestamp) AS window_start, max(timestamp) + INTERVAL 30 MINUTE AS window_end, count(*) AS impressions, CAST(sum(clicked) AS BIGINT) AS clicks
FROM n GROUP BY user_id, session HAVING max(timestamp) + INTERVAL 30 MINUTE <= (SELECT date_trunc('millisecond', max(timestamp)) - INTERVAL 10 MINUTE FROM impressions)""",
    "impressions",
)
def _(spark, sf):
    stream = fx.impressions_of(events_stream(spark, sf))
    return jobs.drain(jobs.stream_user_sessions(stream))
