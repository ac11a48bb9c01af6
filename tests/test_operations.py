"""A/B tests, monitoring, reports, requests and files."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.functions import stats
from adlens.operators import abtest, monitor, profile, requests
from adlens.sources import ab_store, prediction_log, tables

TESTS = "test_id string, model_a string, model_b string, traffic_split double, end_time timestamp_ntz, enabled boolean"


def config_table(spark, *rows):
    return spark.createDataFrame(list(rows), TESTS)


def test_assignment_follows_the_hash(spark):
    config = config_table(spark, ("t", "a", "b", 0.3, None, True))
    users = spark.range(300).select(F.lit("t").alias("test_id"), F.col("id").alias("user_id"))
    for r in abtest.ab_assign(users, config, "2024-01-01 00:00:00").collect():
        ratio = int(hashlib.md5(f"t:{r['user_id']}".encode()).hexdigest(), 16) % 10000 / 10000
        assert (r["variant"], r["model_name"]) == (("B", "b") if ratio < 0.3 else ("A", "a"))


def test_disabled_expired_and_unknown_tests(spark):
    config = config_table(
        spark, ("off", "a", "b", 1.0, None, False), ("old", "a", "b", 1.0, datetime(2024, 1, 1), True),
        ("edge", "a", "b", 1.0, datetime(2024, 1, 2), True),
    )
    asked = spark.createDataFrame([("off", 1), ("old", 1), ("edge", 1), ("none", 1)], "test_id string, user_id int")
    got = {r["test_id"]: r["variant"] for r in abtest.ab_assign(asked, config, "2024-01-02 00:00:00").collect()}
    assert got == {"off": "A", "old": "A", "edge": "B", "none": None}


def test_metrics_of_a_model_with_errors_only(spark):
    log = spark.createDataFrame(
        [("t", "a", 5.0, True, datetime(2024, 1, 1))], "test_id string, model_name string, latency_ms double, error boolean, timestamp timestamp_ntz"
    )
    r = abtest.ab_metrics(log).first()
    assert (r["total_requests"], r["total_predictions"], r["error_count"]) == (1, 0, 1)
    assert r["min_prediction_time_ms"] == float("inf") and r["avg_prediction_time_ms"] == 0.0


def samples(spark, a, b):
    rows = [("t", "A", float(v)) for v in a] + [("t", "B", float(v)) for v in b]
    return spark.createDataFrame(rows, "test_id string, variant string, value double")


A = [50.1, 52.3, 48.8, 55.0, 51.2, 49.9, 53.3]
B = [45.2, 47.7, 50.1, 44.9, 46.3, 48.8]


def test_t_test_effect_and_interval(spark):
    moments = abtest.ab_moments(samples(spark, A, B))
    va, vb, na, nb = np.var(A, ddof=1), np.var(B, ddof=1), len(A), len(B)
    pooled = ((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)
    r = abtest.ab_ttest(moments).first()
    t = (np.mean(A) - np.mean(B)) / np.sqrt(pooled * (1 / na + 1 / nb))
    assert r["t_stat"] == pytest.approx(t) and r["df"] == 11
    assert r["p_value"] == pytest.approx(density_tail(t, 11), abs=1e-6)
    assert abtest.ab_effect(moments).first()["cohens_d"] == pytest.approx((np.mean(A) - np.mean(B)) / np.sqrt(pooled))
    ci = abtest.ab_confidence_interval(moments).first()
    margin = 2.200985 * np.sqrt(va / na + vb / nb)  # t quantile for 11 degrees of freedom
    assert ci["ci_upper"] - ci["difference"] == pytest.approx(margin, rel=1e-6)


def density_tail(t, df):
    """Two-sided tail by integrating the density."""
    from math import gamma, pi, sqrt

    x = np.linspace(-abs(t), abs(t), 200_001)
    density = gamma((df + 1) / 2) / (sqrt(df * pi) * gamma(df / 2)) * (1 + x * x / df) ** (-(df + 1) / 2)
    return 1 - np.trapezoid(density, x)


def test_tails():
    assert stats.t_two_sided(1.959963985, None) == pytest.approx(0.05, abs=1e-9)
    assert stats.t_two_sided(12.7062, 1) == pytest.approx(0.05, abs=1e-6)
    assert stats.t_quantile(0.95, 10) == pytest.approx(2.228139, abs=1e-5)
    assert stats.t_quantile(0.95, 1e9) == pytest.approx(1.959964, abs=1e-6)


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_mann_whitney_counts_pairs(spark, hot_rows):
    r = abtest.ab_mannwhitney(samples(spark, A, B), hot_rows).first()
    assert r["u_stat"] == sum((a > b) + 0.5 * (a == b) for a in A for b in B)
    assert 0 < r["p_value"] < 0.05


def test_chi2_with_correction(spark):
    paired = spark.createDataFrame([("t", 100, 10, 120, 30)], "test_id string, a_total_requests int, a_error_count int, b_total_requests int, b_error_count int")
    table = np.array([[10, 90], [30, 90]], float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    want = ((np.abs(table - expected) - 0.5) ** 2 / expected).sum()
    assert abtest.ab_chi2(paired).first()["chi2"] == pytest.approx(want)


def test_levene_uses_medians(spark):
    z = [np.abs(np.array(g) - np.median(g)) for g in (A, B)]
    n, m = np.array([len(g) for g in z]), np.array([g.mean() for g in z])
    grand = np.concatenate(z).mean()
    want = (n.sum() - 2) * (n * (m - grand) ** 2).sum() / sum(((g - g.mean()) ** 2).sum() for g in z)
    assert abtest.ab_levene(samples(spark, A, B)).first()["f_stat"] == pytest.approx(want)


def test_store_documents(spark, tmp_path):
    tests = {"t1": {"test_id": "t1", "model_a": "one", "model_b": "two", "traffic_split": 0.25, "start_time": "2023-03-05T06:07:08.000009",
                    "end_time": None, "enabled": True, "description": "d"}}
    metrics = {"t1": {m: {"test_id": "t1", "model_name": m, "total_requests": 12, "total_predictions": 10, "avg_prediction_time_ms": 3.5,
                          "total_prediction_time_ms": 35.0, "min_prediction_time_ms": None, "max_prediction_time_ms": 8.0, "error_count": 2,
                          "last_updated": "2023-04-01T00:00:00.5"} for m in ("one", "two")}}
    (tmp_path / "tests.json").write_text(json.dumps(tests, indent=2))
    (tmp_path / "metrics.json").write_text(json.dumps(metrics, indent=2))
    t = ab_store.load_ab_tests(spark, str(tmp_path / "tests.json")).first()
    assert t["start_time"] == datetime(2023, 3, 5, 6, 7, 8, 9) and t["end_time"] is None
    m = ab_store.load_ab_metrics(spark, str(tmp_path / "metrics.json")).collect()
    assert len(m) == 2 and m[0]["min_prediction_time_ms"] == float("inf") and m[0]["total_requests"] == 12


# --- monitoring -------------------------------------------------------------------------------


def log_of(spark, model, values, errors=()):
    rows = [(model, datetime(2024, 1, 1, 0, i // 60, i % 60), i, float(v), i in errors, float(v) / 100) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "model_name string, timestamp timestamp_ntz, request_id int, latency_ms double, error boolean, predicted_ctr double")


BASE = "model_name string, baseline_mean double, baseline_std double, baseline_latency_mean double, baseline_latency_std double"


def test_drift_rules(spark):
    values = [1.0, 3.0] * 60
    current = monitor.drift_window(log_of(spark, "m", values))
    def kinds(mean, std, lat, lat_std):
        base = spark.createDataFrame([("m", mean, std, lat, lat_std)], BASE)
        return {r["type"]: r["severity"] for r in monitor.drift_findings(current, base).collect()}

    # Current: mean 0.02, deviation 0.01, latency 2 +- 1.
    assert kinds(0.02, 0.01, 2.0, 1.0) == {}
    assert kinds(0.02, 0.0, 2.0, 0.0) == {}
    assert kinds(0.045, 0.01, 2.0, 1.0) == {"mean_shift": "medium"}
    assert kinds(0.055, 0.01, 2.0, 1.0) == {"mean_shift": "high"}
    assert kinds(0.02, 0.0055, 2.0, 1.0) == {"variance_change": "medium"}
    assert kinds(0.02, 0.004, 2.0, 1.0) == {"variance_change": "high"}
    assert kinds(0.02, 0.018, 2.0, 1.0) == {"variance_change": "medium"}
    assert kinds(0.02, 0.03, 2.0, 1.0) == {"variance_change": "high"}
    assert kinds(0.02, 0.01, 5.5, 1.0) == {"latency_anomaly": "high"}


def test_too_few_predictions_say_nothing(spark):
    current = monitor.drift_window(log_of(spark, "m", [1.0, 3.0] * 49))
    base = spark.createDataFrame([("m", 9.0, 0.01, 2.0, 1.0)], BASE)
    findings = monitor.drift_findings(current, base)
    assert findings.count() == 0
    r = monitor.drift_status(current, findings).first()
    assert not r["drift_detected"] and r["reason"]


def test_statistics_cover_the_last_rows_only(spark):
    log = log_of(spark, "m", range(50), errors={49, 48})
    r = monitor.last_n_stats(log, 10).first()
    window = list(range(38, 48))
    assert (r["avg_latency_ms"], r["min_latency_ms"], r["max_latency_ms"]) == (np.mean(window), 38, 47)
    assert r["p95_latency_ms"] == pytest.approx(np.percentile(window, 95))
    assert monitor.request_rate(log, 10).first()["requests_per_minute"] == pytest.approx(10 / (9 / 60))
    assert monitor.request_rate(log_of(spark, "m", [1])).first()["requests_per_minute"] == 0.0


def test_health_levels(spark):
    log = log_of(spark, "bad", [5] * 10, errors={1}).unionByName(log_of(spark, "slow", [2000] * 3)).unionByName(log_of(spark, "good", [5] * 3))
    drifted = spark.createDataFrame([("bad",), ("good",)], "model_name string")
    report = monitor.health(monitor.model_stats(log), drifted)
    assert {r["model_name"]: r["status"] for r in report.collect()} == {"bad": "degraded", "slow": "degraded", "good": "warning"}
    compat = monitor.health(monitor.model_stats(log), drifted, compat=True)
    assert {r["model_name"]: r["status"] for r in compat.collect()} == {"bad": "warning", "slow": "degraded", "good": "warning"}
    alerts = {(r["model_name"], r["message"]) for r in monitor.health_alerts(report).collect()}
    assert ("bad", "High error rate: 10.00%") in alerts and ("slow", "High latency: 2000.00ms") in alerts
    assert monitor.overall_health(report).first()["status"] == "degraded"
    assert monitor.overall_health(report.filter("model_name = 'good'")).first()["status"] == "warning"
    assert monitor.overall_health(report.filter("false")).first()["status"] == "healthy"


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_history_of_sliding_figures(spark, hot_rows):
    values = [float((i * 37) % 101) for i in range(60)]
    log = log_of(spark, "m", values, errors={3, 10, 29, 41})
    for r in monitor.metric_history(log, 10, 15, 12, hot_rows).collect():
        seen = [(v, i in {3, 10, 29, 41}) for i, v in enumerate(values)][: r["step"]]
        good = [v for v, bad in seen if not bad][-15:]
        n = min(r["step"], 12)
        assert r["avg_latency_ms"] == pytest.approx(np.mean(good))
        assert r["error_rate"] == pytest.approx(100 * sum(b for _, b in seen) / len(seen))
        assert r["requests_per_minute"] == pytest.approx(n / ((n - 1) / 60))


# --- reports and requests ---------------------------------------------------------------------


def test_reports_on_an_empty_table(impressions):
    empty = impressions.filter("false")
    assert profile.overall_ctr(empty).first()["ctr"] is None
    assert profile.class_balance(empty).count() == 0
    assert {r["missing_percentage"] for r in profile.missing_report(empty).collect()} == {0.0}
    assert profile.describe_numeric(empty, ["hour"]).first()["count"] == 0
    assert profile.trend_line(empty).first()["slope"] is None


def test_describe_ignores_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (4.0,)], "v double")
    r = profile.describe_numeric(df).first()
    assert (r["count"], r["mean"], r["p50"], r["max"]) == (2, 2.5, 2.5, 4.0)
    approx = profile.describe_numeric(df, exact=False).first()
    assert (approx["count"], approx["min"]) == (2, 1.0)


def test_histogram_keeps_the_upper_end(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (1.1,)], "v double")
    got = {r["bin"]: r["count"] for r in profile.value_histogram(df, "v", 2, 0.0, 1.0).collect()}
    assert got == {0: 1, 1: 2}


def test_explanations(spark):
    df = spark.createDataFrame(
        [("mobile", "header", 3, 0.0234), ("watch", "wall", None, 0.0), ("tablet", "popup", 20, 0.5)],
        "device string, placement string, hour int, predicted_ctr double",
    )
    first, second, third = (r["explanation"] for r in requests.explain_prediction(df).collect())
    assert first.startswith("This ad impression has a predicted CTR of **2.34%**. Mobile devices") and first.count(".") == 5
    assert second == "This ad impression has a predicted CTR of **0.00%**. " + requests.BAND_SENTENCES["low"]
    assert third.endswith(requests.BAND_SENTENCES["high"])


def test_comparison_needs_two_models(spark):
    df = spark.createDataFrame([(1, "a", 0.1), (1, "b", 0.1), (2, "a", 0.3)], "request_id int, model_name string, predicted_ctr double")
    rows = requests.compare_predictions(df).collect()
    assert [(r["request_id"], r["best_model"], r["worst_model"], r["difference"]) for r in rows] == [(1, "a", "b", 0.0)]


# --- files ------------------------------------------------------------------------------------


def test_table_round_trips(spark, impressions, tmp_path):
    small = tables.write_table_sized(impressions, str(tmp_path / "small.csv"))
    large = tables.write_table_sized(impressions, str(tmp_path / "large.csv"), limit=10)
    assert small.endswith(".csv") and large.endswith(".parquet")
    want = sorted(map(str, impressions.collect()))
    assert sorted(map(str, tables.read_table(spark, small, impressions.schema).collect())) == want
    assert sorted(map(str, tables.read_table_auto(spark, large).collect())) == want
    impressions.write.parquet(str(tmp_path / "plain"))
    assert sorted(map(str, tables.read_table_auto(spark, str(tmp_path / "plain")).collect())) == want


def test_raw_log(spark, tmp_path):
    import gzip

    path = tmp_path / "train.gz"
    with gzip.open(path, "wt") as f:
        f.write("id,click,hour,C1,banner_pos,device_id,device_ip,device_type,C14,extra\n")
        for i in range(50):
            f.write(f"{i},{i % 2},141021{i % 24:02d},1005,{i % 7},d{i},ip,{1 + i % 5},157{i},e\n")
    assert tables.read_raw_log(spark, str(path), n_rows=7).count() == 7
    assert tables.read_raw_log(spark, str(path), partitions=3).rdd.getNumPartitions() == 3
    df = tables.load_and_prepare(spark, str(path))
    assert df.columns[:4] == ["user_id", "ad_id", "device", "placement"] and "extra" in df.columns
    assert df.filter("timestamp IS NULL").count() == 0 and df.count() == 50


def test_log_rows_and_day_folders(spark, predictions, tmp_path):
    rows = prediction_log.prediction_rows(predictions.drop("request_id").limit(20))
    assert rows.select("request_id").distinct().count() == 20
    assert set(json.loads(rows.first()["features"])) == {"timestamp"}
    path = str(tmp_path / "log")
    log = predictions.withColumn("device", F.lit("mobile"))
    prediction_log.append_predictions(log, path)
    prediction_log.append_predictions(log, path)
    assert prediction_log.read_log(spark, path).count() == 2 * predictions.count()
    plan = prediction_log.read_log(spark, path, "2024-01-20")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert prediction_log.user_predictions(log, 7).count() == predictions.filter("user_id = 7").count()


def test_command_line(spark, impressions, tmp_path, capsys):
    from adlens.__main__ import main

    source = str(tmp_path / "in.parquet")
    impressions.write.parquet(source)
    main(["create-features", "--input", source, "--output", str(tmp_path / "f.parquet"), "--state", str(tmp_path / "s"), "--sample-frac", "0.5"])
    assert spark.read.parquet(str(tmp_path / "f.parquet")).count() == 500
    main(["explore", "--input", source, "--output", str(tmp_path / "reports")])
    assert (tmp_path / "reports" / "ctr_by_hour.csv").exists()
    main(["train", "--input", str(tmp_path / "f.parquet"), "--output-dir", str(tmp_path / "m"), "--models", "logistic"])
    assert "logistic" in capsys.readouterr().out


def test_mixed_folder_is_refused(spark, tmp_path):
    import pytest

    from adlens.sources.tables import read_table_auto

    spark.range(3).write.parquet(str(tmp_path / "mixed"))
    for n in range(25):
        (tmp_path / "mixed" / f"a{n:02d}.csv").write_text("id\n1\n")
    with pytest.raises(ValueError):
        read_table_auto(spark, str(tmp_path / "mixed"))


def test_files_with_other_headers_are_read_by_their_own(spark, tmp_path):
    import gzip

    folder = tmp_path / "logs of the day"
    folder.mkdir()
    (folder / "a.csv").write_text("click,hour\n1,14102101\n0,14102102\n")
    (folder / "b.csv").write_text('\ufeffhour,"click",more\n14102103,1,"x,y"\n')
    (folder / "c.csv").write_text("")
    (folder / "d.csv").write_text("hour,click\n")
    with gzip.open(folder / "e.csv.gz", "wt") as f:
        f.write("click,hour\n" + "".join(f"{i % 2},1410220{i % 10}\n" for i in range(30_000)))
    df = tables.read_raw_log(spark, str(folder))
    assert sorted(df.columns) == ["click", "hour", "more"]
    assert dict(df.dtypes)["click"] == "int"
    rows = df.collect()
    assert len(rows) == 30_003 and sum(r["click"] for r in rows) == 15_002
    assert [(r["hour"], r["more"]) for r in rows if r["more"]] == [("14102103", "x,y")]
    found = tables.file_headers(spark, str(folder))
    assert sorted(f.rsplit("/", 1)[-1] for f in found) == ["a.csv", "b.csv", "d.csv", "e.csv.gz"]


def test_a_batch_written_again_replaces_itself(spark, predictions, tmp_path):
    path = str(tmp_path / "log")
    rows = prediction_log.prediction_rows(predictions.withColumn("predicted_ctr", F.when(F.col("request_id") % 10 != 0, F.col("predicted_ctr"))))
    one, two = rows.filter("CAST(request_id AS INT) % 2 = 0"), rows.filter("CAST(request_id AS INT) % 2 = 1")
    first = prediction_log.log_batch(one, path, "one")
    assert (first.logged, first.refused, first.with_actual) == (one.count(), one.filter("predicted_ctr IS NULL").count(), one.filter("actual_ctr IS NOT NULL").count())
    prediction_log.log_batch(two, path, "two")
    assert prediction_log.log_batch(one, path, "one") == first
    assert prediction_log.read_log(spark, path).count() == rows.count()
    assert prediction_log.log_batch(one.limit(0), path, "none").logged == 0


def test_unscored_request_is_logged_without_a_rate(spark):
    import json

    from adlens.sources.prediction_log import prediction_rows

    scored = spark.createDataFrame(
        [("u", None, "unusable feature value")], "user_id string, predicted_ctr double, score_error string"
    )
    row = prediction_rows(scored, "2024-01-01 00:00:00").first()
    assert row["predicted_ctr"] is None and json.loads(row["features"])["score_error"] == "unusable feature value"
