"""Training job: split, fit every model, evaluate, save."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.operators import evaluate, models
from adlens.operators.normalize import numeric_columns
from adlens.operators.sampling import split_train_val_test
from adlens.sources.materialise import materialise
from adlens.sources.tables import write_report


@dataclass
class TrainingResult:
    models: dict[str, Model]
    features: list[str]
    validation: DataFrame
    test: DataFrame

    def comparison(self) -> DataFrame:
        return evaluate.model_comparison(self.test)

    def save(self, path: str) -> None:
        """Every model under its name, and the comparison as evaluation_results.csv."""
        for name, model in self.models.items():
            model.write().overwrite().save(f"{path}/{name}")
        write_report(self.comparison(), f"{path}/evaluation_results.csv")


def scored_rows(df: DataFrame, fitted: dict[str, Model], features: Sequence[str], target: str, row_id: str) -> DataFrame:
    """(id, model_name, label, score) of every model on the same rows."""
    filled = df.select(row_id, target, *[models.known_value(c).alias(c) for c in features])
    return models.compare_models(filled, fitted, features).select(
        F.col(row_id).alias("id"), "model_name", F.col(target).cast("int").alias("label"), F.col("predicted_ctr").alias("score")
    )


def train_models(
    df: DataFrame,
    names: Sequence[str] = ("logistic", "xgboost", "lightgbm"),
    target: str = "clicked",
    row_id: str = "impression_id",
    test_size: float = 0.2,
    val_size: float = 0.2,
    seed: int = 42,
    options: dict[str, dict] | None = None,
) -> TrainingResult:
    """Train on 64 % of the rows, stop boosting by the next 16 %, test on the last 20 %.

    The split rows are written once, so that every fit and evaluation reads the same narrow table.
    """
    unknown = set(names) - set(models.TRAINERS)
    if unknown:
        raise ValueError(f"unknown models: {sorted(unknown)}")
    features = numeric_columns(df, [target, row_id])
    narrow = df.select(row_id, target, *features)
    split = materialise(split_train_val_test(narrow, test_size, val_size, (target,), row_id, seed), "training")
    train_and_val = split.filter(F.col("split") != "test").withColumn("_val", F.col("split") == "val")
    train = split.filter(F.col("split") == "train")
    fitted = {}
    for name in names:
        extra = (options or {}).get(name, {})
        if name == "logistic":
            fitted[name] = models.train_logistic(train, features, target, **extra)
        else:
            extra = {"row_id": row_id, **extra} if name == "lightgbm" else extra
            fitted[name] = models.TRAINERS[name](train_and_val, features, target, validation="_val", **extra)
    held = split.filter(F.col("split") != "train")
    scores = materialise(
        scored_rows(held, fitted, features, target, row_id).join(
            held.select(F.col(row_id).alias("id"), "split"), "id"
        ),
        "scores",
    )
    return TrainingResult(
        fitted,
        features,
        evaluate.evaluate(scores.filter(F.col("split") == "val")),
        evaluate.evaluate(scores.filter(F.col("split") == "test")),
    )
