"""Scoring job: the one path every request takes, single or batch, with or without an A/B test."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.operators import abtest, models, requests
from adlens.plans.feature_table import FeatureState, transform
from adlens.sources.materialise import materialise
from adlens.sources.prediction_log import prediction_rows


def route(df: DataFrame, tests: DataFrame | None, now: str, default_model: str) -> DataFrame:
    """Choose the model of each request: by its A/B test if it names one, else the default."""
    if tests is None or "test_id" not in df.columns:
        return df.withColumns({"variant": F.lit(None).cast("string"), "model_name": F.lit(default_model)})
    assigned = abtest.ab_assign(df, tests, now)
    return assigned.withColumn(
        "model_name", F.when(F.col("test_id").isNull(), F.lit(default_model)).otherwise(F.col("model_name"))
    )


def score_requests(
    incoming: DataFrame,
    state: FeatureState,
    fitted: Mapping[str, Model],
    features: Sequence[str],
    now: str,
    tests: DataFrame | None = None,
    default_model: str = "xgboost",
    default_ctr: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(scored, rejected) requests. Each row is scored once, by the model it was routed to."""
    checked = requests.validate_requests(incoming)
    good = requests.prepare_requests(requests.accepted(checked), now)
    routed = route(good, tests, now, default_model)
    unroutable = routed.filter(F.col("model_name").isNull() | ~F.col("model_name").isin(list(fitted)))
    refused = requests.rejected(checked).unionByName(
        unroutable.withColumn("reject_reason", F.lit("no such test or model")).select(*checked.columns)
    )
    built = transform(routed, state, select=False)
    missing = {c: F.lit(0.0) for c in features if c not in built.columns}
    # Written once: otherwise every model would repeat the joins of the feature step.
    aligned = materialise(built.withColumns(missing) if missing else built, "requests")
    parts = [
        models.score_batch(
            aligned.filter(F.col("model_name") == name).drop("model_name"), fitted, features, name, default_ctr
        )
        for name in fitted
    ]
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return scored, refused


def log_rows(scored: DataFrame, logged_at: str | None = None) -> DataFrame:
    return prediction_rows(scored, logged_at)
