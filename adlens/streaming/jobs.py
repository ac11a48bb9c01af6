"""Structured Streaming over the prediction log.

Inputs are streaming log rows with zone-less `timestamp`, as the batch operators take. Windows need
an instant, so event time is read as UTC whatever the session zone; results are zone-less again.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from adlens.operators import abtest, monitor
from adlens.sources.materialise import shared_folder

MODEL = "model_name"


def with_event_time(log: DataFrame, delay: str = "10 minutes", column: str = "timestamp", name: str = "event_time") -> DataFrame:
    instant = F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), F.col(column)))
    return log.withColumn(name, instant).withWatermark(name, delay)


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def _zoneless(instant: str) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def _window_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        _zoneless("window.start").alias("window_start"),
        _zoneless("window.end").alias("window_end"),
        *columns,
    )


def start_parquet_sink(df: DataFrame, path: str, checkpoint: str, once: bool = False, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append a stream to parquet, exactly once per row."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def stream_predictions(rows: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """The prediction log itself: day folders, appended as rows arrive."""
    dated = rows.withColumn("date", F.to_date("timestamp"))
    return start_parquet_sink(dated, path, checkpoint, once, ("date",))


def stream_model_stats(log: DataFrame, window: str = "1 hour", delay: str = "10 minutes", accuracy: int = 10_000) -> DataFrame:
    """Per model and tumbling window: counters, latency figures, request rate."""
    ok = F.when(~F.col("error"), F.col("latency_ms"))
    n, bad = F.count(F.lit(1)), F.count_if("error")
    grouped = (
        with_event_time(log, delay)
        .groupBy(F.window("event_time", window), MODEL)
        .agg(
            n.alias("total_requests"),
            (n - bad).alias("successful_requests"),
            bad.alias("error_count"),
            (bad * 100 / n).alias("error_rate"),
            F.avg(ok).alias("avg_latency_ms"),
            F.percentile_approx(ok, F.lit(0.5), F.lit(accuracy)).alias("p50_latency_ms"),
            F.percentile_approx(ok, F.lit(0.95), F.lit(accuracy)).alias("p95_latency_ms"),
            F.percentile_approx(ok, F.lit(0.99), F.lit(accuracy)).alias("p99_latency_ms"),
            F.min(ok).alias("min_latency_ms"),
            F.max(ok).alias("max_latency_ms"),
            F.avg(F.when(~F.col("error"), F.col("predicted_ctr"))).alias("mean_prediction"),
            F.stddev_pop(F.when(~F.col("error"), F.col("predicted_ctr"))).alias("std_prediction"),
            F.stddev_pop(ok).alias("std_latency_ms"),
        )
    )
    minutes = (F.unix_seconds("window.end") - F.unix_seconds("window.start")) / 60
    rated = grouped.withColumn("requests_per_minute", F.col("total_requests") / minutes)
    return _window_columns(rated, *[c for c in rated.columns if c != "window"])


def stream_sliding_rate(log: DataFrame, window: str = "5 minutes", slide: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Requests per minute in overlapping windows."""
    counted = (
        with_event_time(log, delay)
        .groupBy(F.window("event_time", window, slide), MODEL)
        .agg(F.count(F.lit(1)).alias("requests"))
    )
    minutes = (F.unix_seconds("window.end") - F.unix_seconds("window.start")) / 60
    rated = counted.withColumn("requests_per_minute", F.col("requests") / minutes)
    return _window_columns(rated, MODEL, "requests", "requests_per_minute")


def stream_ab_metrics(requests: DataFrame, tests: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Assign variants as requests arrive and count per test, model and window.

    `requests` carries test_id, user_id, latency_ms, error and timestamp, but no model yet.
    """
    assigned = with_event_time(abtest.ab_assign(requests, tests), delay)
    ok = F.when(~F.col("error"), F.col("latency_ms"))
    counted = assigned.groupBy(F.window("event_time", window), "test_id", MODEL).agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(~F.col("error")).alias("total_predictions"),
        F.avg(ok).alias("avg_prediction_time_ms"),
        F.count_if("error").alias("error_count"),
    )
    return _window_columns(counted, *[c for c in counted.columns if c != "window"])


def stream_window_drift(stats: DataFrame, baseline: DataFrame, minimum: int = monitor.DRIFT_MINIMUM) -> DataFrame:
    """Deviations of each window of `stream_model_stats` from a stored baseline."""
    current = stats.select(
        "window_start",
        MODEL,
        F.col("successful_requests").alias("n"),
        F.col("mean_prediction").alias("current_mean"),
        F.col("std_prediction").alias("current_std"),
        F.col("avg_latency_ms").alias("current_latency_mean"),
        F.col("std_latency_ms").alias("current_latency_std"),
    )
    return monitor.drift_findings(current, baseline, minimum=minimum, keep=("window_start",))


STATE_FORMAT = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATS_SCHEMA = (
    f"{MODEL} string, n long, current_mean double, current_std double, current_latency_mean double, current_latency_std double"
)


class LastRequests(StatefulProcessor):
    """Keeps the newest `n` rows of a model as keyed state and emits their statistics whenever rows arrive.

    Newest is by time and tie-breaker, not by arrival, so late rows and the cut into micro-batches do not matter.
    """

    columns = ("at", "tie", "predicted_ctr", "latency_ms")

    def __init__(self, n: int, tie_type: str):
        self.n, self.state_schema = n, f"at long, tie {tie_type}, predicted_ctr double, latency_ms double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", self.state_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        kept = [tuple(r) for r in self.rows.get()]
        for frame in rows:
            kept += frame[list(self.columns)].itertuples(index=False, name=None)
            # Size bound: what is kept and one Arrow batch.
            kept = heapq.nlargest(self.n, kept, key=lambda r: r[:2])
        self.rows.put([tuple(None if v is None or v != v else v for v in r) for r in kept])
        columns = {MODEL: [key[0]], "n": [len(kept)]}
        for name, at in (("current", 2), ("current_latency", 3)):
            values = np.array([r[at] for r in kept if r[at] is not None and r[at] == r[at]], float)
            columns[f"{name}_mean"] = [values.mean() if len(values) else None]
            columns[f"{name}_std"] = [values.std() if len(values) else None]
        yield pd.DataFrame(columns)

    def close(self) -> None:
        pass


def stream_current_stats(log: DataFrame, n: int = monitor.DRIFT_WINDOW) -> DataFrame:
    """Statistics of the last `n` successful predictions of each model with new rows, as a stream of updates.

    Each task first drops what cannot be among a model's last `n`, so a model with most of the rows sends no more
    than `n` of them from each task to the one that holds its state.
    """
    tie = monitor.ORDER[1]
    tie_type = log.schema[tie].dataType.simpleString()
    lowest = F.lit("").cast("string") if tie_type == "string" else F.lit(-(2**63)).cast(tie_type)
    rows = log.filter(~F.col("error") & F.col("predicted_ctr").isNotNull() & F.col(MODEL).isNotNull()).select(
        MODEL,
        F.coalesce(F.timestamp_diff("MICROSECOND", _epoch(), F.col(monitor.ORDER[0])), F.lit(-(2**63))).alias("at"),
        F.coalesce(tie, lowest).alias("tie"),
        "predicted_ctr",
        F.col("latency_ms").cast("double").alias("latency_ms"),
    )

    def newest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for frame in frames:
            both = frame if kept is None else pd.concat([kept, frame])
            kept = both.sort_values(["at", "tie"]).groupby(MODEL, sort=False).tail(n)
        if kept is not None:
            yield kept

    return (
        rows.mapInPandas(newest, rows.schema)
        .groupBy(MODEL)
        .transformWithStateInPandas(LastRequests(n, tie_type), STATS_SCHEMA, "update", "none")
    )


def start_drift(
    log: DataFrame,
    baseline: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    n: int = monitor.DRIFT_WINDOW,
    minimum: int = monitor.DRIFT_MINIMUM,
) -> StreamingQuery:
    """After every micro-batch: deviations from the baseline of each model that had new rows.

    The statistics of a batch go to `path`/current/epoch=<batch>, its findings to `path`/findings/epoch=<batch>, both
    replaced if the batch is repeated. The state is in the checkpoint, in the state store that keeps it on disk.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        target = f"{path}/current/epoch={epoch}"
        batch.write.mode("overwrite").parquet(target)
        current = batch.sparkSession.read.schema(STATS_SCHEMA).parquet(target)
        found = monitor.drift_findings(current, baseline, minimum=minimum)
        found.write.mode("overwrite").parquet(f"{path}/findings/epoch={epoch}")

    conf, name = log.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, STATE_FORMAT)  # a query keeps the setting it was started with
    try:
        return start_batches(stream_current_stats(log, n), step, checkpoint, once, "update")
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def latest_findings(spark: SparkSession, path: str, baseline: DataFrame, minimum: int = monitor.DRIFT_MINIMUM) -> DataFrame:
    """Where every model stands now: deviations of its newest statistics that `start_drift` wrote to `path`."""
    current = spark.read.schema(f"{STATS_SCHEMA}, epoch int").parquet(f"{path}/current")
    fields = [F.struct(*[c for c in current.columns if c not in (MODEL, "epoch")])]
    newest = current.groupBy(MODEL).agg(F.max_by(*fields, "epoch").alias("_now")).select(MODEL, "_now.*")
    return monitor.drift_findings(newest, baseline, minimum=minimum)


def start_batches(
    df: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, once: bool, mode: str = "append"
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_alerts(stats: DataFrame, baseline: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Health alerts of every finished window of `stream_model_stats`, written per batch."""

    def step(batch: DataFrame, epoch: int) -> None:
        window_alerts(batch, baseline).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return start_batches(stats, step, checkpoint, once)


def window_alerts(stats: DataFrame, baseline: DataFrame) -> DataFrame:
    """Alerts per model and window, from the window's own error rate, latency and drift."""
    drifted = stream_window_drift(stats, baseline).select(MODEL, "window_start").distinct()
    report = monitor.health(stats, drifted, keys=(MODEL, "window_start"))
    return report.select("window_start", MODEL, F.inline("alerts"))


def stream_feedback(
    predictions: DataFrame, feedback: DataFrame, within: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """Predictions joined to outcomes that arrive within a time bound; outcome null if none did."""
    p = with_event_time(predictions, delay, name="predicted_at")
    f = with_event_time(feedback, delay, name="observed_at").select(
        F.col("request_id").alias("_request"), F.col("actual_ctr").alias("_actual"), "observed_at"
    )
    matched = p.join(
        f,
        (F.col("request_id") == F.col("_request"))
        & (F.col("observed_at") >= F.col("predicted_at"))
        & (F.col("observed_at") <= F.col("predicted_at") + F.expr(f"INTERVAL {within}")),
        "left",
    )
    kept = [c for c in predictions.columns if c != "actual_ctr"]
    return matched.select(*kept, F.col("_actual").alias("actual_ctr"))


def stream_user_sessions(impressions: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Sessions of a user: impressions no further apart than `gap`."""
    sessions = (
        with_event_time(impressions, delay)
        .groupBy(F.session_window("event_time", gap).alias("window"), "user_id")
        .agg(F.count(F.lit(1)).alias("impressions"), F.sum("clicked").alias("clicks"))
    )
    return _window_columns(sessions, "user_id", "impressions", "clicks")


def drain(stream: DataFrame) -> DataFrame:
    """Run an append stream over all data available now and read back what it wrote."""
    folder = f"{shared_folder(stream.sparkSession)}/drain-{uuid4().hex}"
    query = start_parquet_sink(stream, f"{folder}/rows", f"{folder}/checkpoint", once=True)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")
