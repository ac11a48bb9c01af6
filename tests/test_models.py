from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.operators import evaluate, models
from adlens.plans import feature_table, scoring, training


@pytest.fixture(scope="module")
def rows(spark):
    """A learnable target with both classes at every split."""
    return spark.range(600).select(
        F.col("id").alias("impression_id"),
        (F.col("id") % 10).cast("double").alias("x"),
        F.rand(1).alias("noise"),
        ((F.col("id") % 10 > 6) | (F.col("id") % 37 == 0)).cast("int").alias("clicked"),
    ).cache()


def auc(labels, scores):
    wins = [(p > q) + 0.5 * (p == q) for p in scores[labels == 1] for q in scores[labels == 0]]
    return np.mean(wins)


def average_precision(labels, scores):
    total = 0.0
    for s in sorted(set(scores), reverse=True):
        at = scores >= s
        total += (labels[scores == s].sum() / labels.sum()) * labels[at].mean()
    return total


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_rank_metrics_match_their_definition(spark, hot_rows):
    rng = np.random.default_rng(5)
    data = {m: (rng.integers(0, 2, 200), np.round(rng.random(200), 1 + i)) for i, m in enumerate("ab")}
    rows = [(m, int(y), float(s)) for m, (ys, ss) in data.items() for y, s in zip(ys, ss)]
    df = spark.createDataFrame(rows, "model_name string, label int, score double")
    for r in evaluate.evaluate(df, hot_rows=hot_rows).collect():
        labels, scores = data[r["model_name"]]
        p = np.clip(scores, evaluate.EPSILON, 1 - evaluate.EPSILON)
        assert r["roc_auc"] == pytest.approx(auc(labels, scores))
        assert r["pr_auc"] == pytest.approx(average_precision(labels, scores))
        assert r["log_loss"] == pytest.approx(-np.mean(np.where(labels == 1, np.log(p), np.log(1 - p))))
        assert r["accuracy"] == pytest.approx(np.mean((scores >= 0.5) == labels))


def test_one_class_has_no_ranking(spark):
    df = spark.createDataFrame([("m", 0, 0.2), ("m", 0, 0.4)], "model_name string, label int, score double")
    r = evaluate.evaluate(df).first()
    assert r["roc_auc"] is None and r["pr_auc"] is None and r["accuracy"] == 1.0


def test_curves_start_and_end_where_they_should(spark):
    df = spark.createDataFrame([("m", 0, 0.1), ("m", 1, 0.4), ("m", 0, 0.4), ("m", 1, 0.9)], "model_name string, label int, score double")
    roc = sorted((r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df).collect())
    assert roc == [(0.0, 0.0), (0.0, 0.5), (0.5, 1.0), (1.0, 1.0)]
    pr = sorted((r["recall"], r["precision"]) for r in evaluate.pr_curve(df).collect())
    assert pr == [(0.0, 1.0), (0.5, 1.0), (1.0, 0.5), (1.0, pytest.approx(2 / 3))]


def test_calibration_edges_belong_to_the_lower_bin(spark):
    df = spark.createDataFrame([("m", 1, s) for s in (0.0, 0.1, 0.100001, 0.3, 1.0)], "model_name string, label int, score double")
    got = {r["bin"]: r["count"] for r in evaluate.calibration_curve(df).collect()}
    assert got == {1: 2, 2: 1, 3: 1, 10: 1}


def test_models_learn_and_score(rows):
    features = ["x", "noise"]
    for name in ("logistic", "xgboost", "lightgbm"):
        extra = {} if name == "logistic" else {"rounds": 10}
        model = models.TRAINERS[name](rows, features, **extra)
        scored = models.score_batch(rows, {name: model}, features, name)
        r = evaluate.evaluate(scored.selectExpr("model_name", "clicked AS label", "predicted_ctr AS score")).first()
        assert r["roc_auc"] > 0.85, name


def test_unknown_model_is_an_error(rows):
    with pytest.raises(ValueError):
        models.score_batch(rows, {}, ["x"], "xgboost")


def test_unusable_rows_are_reported_not_guessed(rows):
    model = models.train_logistic(rows, ["x"])
    holes = rows.withColumn("x", F.when(F.col("impression_id") > 2, F.col("x")))
    scored = models.score_batch(holes, {"logistic": model}, ["x"], "logistic").filter("impression_id <= 2").collect()
    assert all(r["predicted_ctr"] is None and r["score_error"] for r in scored)
    default = models.score_batch(holes, {"logistic": model}, ["x"], "logistic", models.DEFAULT_CTR)
    assert default.filter("score_error IS NOT NULL").first()["predicted_ctr"] == 0.02


def test_calibration_is_monotone(rows):
    scored = rows.select(F.lit("m").alias("model_name"), F.col("clicked").alias("label"), (F.col("x") / 20).alias("score"))
    for fit, apply in ((models.fit_platt, models.apply_platt), (models.fit_isotonic, models.apply_isotonic)):
        got = [r["calibrated"] for r in apply(fit(scored), scored).orderBy("score").collect()]
        assert got == sorted(got)


def test_training_job(rows, tmp_path):
    result = training.train_models(rows, ["logistic", "lightgbm"], options={"lightgbm": {"rounds": 5}})
    assert result.features == ["x", "noise"]
    assert {r["model_name"] for r in result.comparison().collect()} == {"logistic", "lightgbm"}
    assert result.test.agg(F.min("roc_auc")).first()[0] > 0.8
    result.save(str(tmp_path / "models"))
    assert (tmp_path / "models" / "evaluation_results.csv").exists()
    with pytest.raises(ValueError):
        training.train_models(rows, ["other"])


def test_importance_names_the_informative_feature(rows):
    model = models.train_gbt(rows, ["noise", "x"], rounds=3)
    assert models.feature_importance(model, ["noise", "x"], rows).first()["feature"] == "x"


def test_scoring_job_routes_and_refuses(spark, impressions):
    features = ["hour", "ctr_user_id_user"]
    built, state = feature_table.fit_transform(
        impressions, feature_table.FeatureOptions(apply_selection=False, hashed_columns=())
    )
    fitted = {"logistic": models.train_logistic(built, features), "xgboost": models.train_gbt(built, features, rounds=2)}
    tests = spark.createDataFrame(
        [("on", "logistic", "xgboost", 1.0, None, True), ("off", "logistic", "xgboost", 1.0, None, False),
         ("gone", "logistic", "missing", 1.0, None, True)],
        "test_id string, model_a string, model_b string, traffic_split double, end_time timestamp_ntz, enabled boolean",
    )
    incoming = spark.createDataFrame(
        [(1, "on", "1", "5", "mobile", "footer", 3), (2, "off", "1", "5", "mobile", "footer", 3),
         (3, None, "1", "5", "mobile", "footer", None), (4, "on", None, "5", "mobile", "footer", 3),
         (5, "nope", "1", "5", "mobile", "footer", 3), (6, "gone", "1", "5", "mobile", "footer", 3),
         (7, "on", "1", "5", "mobile", "footer", 31)],
        "request_id int, test_id string, user_id string, ad_id string, device string, placement string, hour int",
    ).withColumns({"timestamp": F.lit(None).cast("timestamp_ntz"), "day_of_week": F.lit(None).cast("int")})
    incoming = incoming.withColumns({c: F.col(c).cast("bigint") for c in ("user_id",)}).withColumn("ad_id", F.col("ad_id").cast("int"))
    scored, refused = scoring.score_requests(incoming, state, fitted, features, "2024-02-01 10:00:00", tests)
    got = {r["request_id"]: (r["model_name"], r["variant"], r["hour"]) for r in scored.collect()}
    assert got == {1: ("xgboost", "B", 3), 2: ("logistic", "A", 3), 3: ("xgboost", None, 10)}
    reasons = {r["request_id"]: r["reject_reason"] for r in refused.collect()}
    assert set(reasons) == {4, 5, 6, 7} and reasons[4] == "missing user_id"
    assert all(0 <= r["predicted_ctr"] <= 1 for r in scored.collect())
    assert scoring.log_rows(scored, "2024-02-01 10:00:00").count() == 3


def test_boosting_keeps_the_best_round_and_waits():
    from adlens.operators.models import best_round

    assert best_round([0.9, 0.8, 0.81, 0.7, 0.71], 10) == 4
    assert best_round([0.9, 0.8, 0.81, 0.82, 0.1], 2) == 2
    assert best_round([0.9, 0.8, 0.7], 2) == 3
    assert best_round([float("nan")] * 3, 2) == 3


def test_boosting_is_not_one_tree(spark):
    from pyspark.sql import functions as F

    from adlens.operators.models import train_gbt

    rows = spark.range(2000).select(
        (F.col("id") % 17).cast("double").alias("a"),
        (F.col("id") % 5).cast("double").alias("b"),
        (((F.col("id") % 17) + 3 * (F.col("id") % 5) > 12) & (F.pmod(F.xxhash64("id"), F.lit(10)) > 1)).cast("int").alias("clicked"),
        (F.col("id") % 4 == 0).alias("held"),
    )
    assert train_gbt(rows, ["a", "b"], rounds=12, max_depth=2, validation="held").getNumTrees > 3


def test_missing_values_are_scored_in_evaluation(spark):
    from adlens.operators.models import train_logistic
    from adlens.plans.training import scored_rows

    rows = spark.createDataFrame(
        [(i, i % 2, float("nan") if i % 3 == 0 else float(i)) for i in range(60)], "id long, clicked int, a double"
    )
    out = scored_rows(rows, {"logistic": train_logistic(rows, ["a"])}, ["a"], "clicked", "id")
    assert out.filter("score IS NULL").count() == 0 and out.count() == 60
