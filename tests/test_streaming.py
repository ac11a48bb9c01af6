from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from adlens.operators import monitor
from adlens.streaming import jobs

SCHEMA = "request_id bigint, model_name string, timestamp timestamp_ntz, latency_ms double, error boolean, predicted_ctr double"


def batch(spark, path, start, n, first=0):
    begin = datetime(2024, 1, 1) + timedelta(minutes=start)
    rows = [
        (first + i, "m" if i % 2 else "n", begin + timedelta(seconds=i), float(i % 17), i % 10 == 0, (i % 17) / 100)
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    df.coalesce(1).write.mode("append").parquet(path)
    return df


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).parquet(path)


def test_state_holds_the_last_rows_of_all_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    base = spark.createDataFrame(
        [("m", 0.5, 0.01, 8.0, 5.0), ("n", 0.08, 0.05, 8.0, 5.0)],
        "model_name string, baseline_mean double, baseline_std double, baseline_latency_mean double, baseline_latency_std double",
    )
    everything = None
    for k in range(3):
        part = batch(spark, source, k * 60, 300, k * 1000)
        everything = part if everything is None else everything.unionByName(part)
        # Each turn is a restart from the checkpoint.
        jobs.start_drift(stream(spark, source), base, out, f"{out}/checkpoint", once=True, n=200).awaitTermination()
        want = monitor.drift_findings(monitor.drift_window(everything, 200), base)
        got = jobs.latest_findings(spark, out, base)
        assert sorted(rounded(r) for r in got.collect()) == sorted(rounded(r) for r in want.collect())
    assert got.filter("type = 'mean_shift' AND model_name = 'm'").count() == 1
    assert {r["n"] for r in spark.read.parquet(f"{out}/current").filter("epoch = 2").collect()} == {200}


def rounded(row):
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


def test_state_does_not_depend_on_the_cut_into_batches(spark, tmp_path):
    """Rows of all times in every batch, one batch per file, and a model that only the first batch has."""
    source = str(tmp_path / "in")
    rows = batch(spark, str(tmp_path / "all"), 0, 400).withColumn("file", F.col("request_id") % 5)
    only = rows.filter("file = 0").limit(20).withColumn("model_name", F.lit("once")).withColumn("error", F.lit(False))
    late = rows.unionByName(only).withColumn("timestamp", F.when(F.col("request_id") % 37 != 0, F.col("timestamp")))
    late = late.withColumn("latency_ms", F.when(F.col("request_id") % 11 != 0, F.col("latency_ms"))).cache()
    for k in range(5):
        late.filter(F.col("file") == k).drop("file").coalesce(1).write.mode("append").parquet(source)
    out = str(tmp_path / "out")
    files = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    empty = spark.createDataFrame([], "model_name string, baseline_mean double, baseline_std double, baseline_latency_mean double, baseline_latency_std double")
    jobs.start_drift(files, empty, out, f"{out}/checkpoint", once=True, n=50).awaitTermination()
    written = spark.read.parquet(f"{out}/current")
    assert written.select("epoch").distinct().count() == 5
    newest = {r["model_name"]: r for r in written.orderBy("epoch").collect()}
    for r in monitor.drift_window(late.drop("file"), 50).collect():
        got = newest[r["model_name"]]
        assert got["n"] == r["n"]
        for c in ("current_mean", "current_std", "current_latency_mean", "current_latency_std"):
            assert abs(got[c] - r[c]) < 1e-9
    assert newest["once"]["epoch"] < 4


def test_late_rows_are_dropped_after_the_watermark(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        stats = jobs.stream_model_stats(stream(spark, source), window="1 hour", delay="10 minutes")
        jobs.start_parquet_sink(stats, f"{out}/rows", f"{out}/checkpoint", once=True).awaitTermination()

    batch(spark, source, 10, 100)
    run()
    batch(spark, source, 200, 10, 1000)
    run()
    batch(spark, source, 15, 40, 2000)  # its window is final by now
    batch(spark, source, 600, 10, 3000)
    run()
    got = spark.read.parquet(f"{out}/rows").filter("window_start = TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    assert sorted((r["model_name"], r["total_requests"]) for r in got.collect()) == [("m", 50), ("n", 50)]


def test_log_folders_by_day(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    batch(spark, source, 23 * 60 + 59, 120)
    jobs.stream_predictions(stream(spark, source), out, f"{out}-checkpoint", once=True).awaitTermination()
    jobs.stream_predictions(stream(spark, source), out, f"{out}-checkpoint", once=True).awaitTermination()
    assert {str(r["date"]): r["count"] for r in spark.read.parquet(out).groupBy("date").count().collect()} == {
        "2024-01-01": 60, "2024-01-02": 60,
    }


def test_alerts_name_the_window(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    part = batch(spark, source, 0, 100)
    batch(spark, source, 300, 10, 1000)
    stats = jobs.stream_model_stats(stream(spark, source))
    base = monitor.baseline_fit(part)
    jobs.start_alerts(stats, base, out, f"{out}-checkpoint", once=True).awaitTermination()
    got = {(r["model_name"], r["message"]) for r in spark.read.parquet(out).collect() if r["window_start"] == datetime(2024, 1, 1)}
    assert got == {("n", "High error rate: 20.00%")}
