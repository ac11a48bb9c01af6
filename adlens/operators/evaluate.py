"""Evaluation of scored rows (model_name, label 0/1, score), for any number of models at once.

Rank metrics work on distinct scores: ties collapse on the map side, and the running counts over
scores are split in balanced ranges, so no task orders a whole model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.operators.ordered import value_counts_running

MODEL = "model_name"
EPSILON = 2.220446049250313e-16  # smallest step of a double at 1: keeps logarithms finite


def score_ranks(scored: DataFrame, decimals: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """Positives and negatives at, below and in total, per model and distinct score."""
    if decimals is not None:
        scored = scored.withColumn("score", F.round("score", decimals))
    label = F.col("label")
    return value_counts_running(scored, [MODEL], "score", {"pos": label, "neg": 1 - label}, hot_rows)


def rank_metrics(scored: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """ROC-AUC (ties count half) and average precision; null when a model saw one class only."""
    at_or_above = F.col("t_pos") - F.col("b_pos")
    flagged = at_or_above + F.col("t_neg") - F.col("b_neg")
    wins = F.col("n_pos") * (F.col("b_neg") + F.col("n_neg") / F.lit(2))
    steps = F.col("n_pos") * at_or_above / flagged
    return (
        score_ranks(scored, hot_rows=hot_rows)
        .groupBy(MODEL)
        .agg(
            F.try_divide(F.sum(wins), F.max("t_pos") * F.max("t_neg").cast("double")).alias("roc_auc"),
            F.try_divide(F.sum(steps), F.max("t_pos")).alias("pr_auc"),
        )
    )


def loss_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    label = F.col("label")
    p = F.least(F.greatest(F.col("score"), F.lit(EPSILON)), F.lit(1 - EPSILON))
    loss = -F.when(label == 1, F.ln(p)).otherwise(F.ln(1 - p))
    hit = ((F.col("score") >= threshold).cast("int") == label).cast("int")
    return scored.groupBy(MODEL).agg(F.avg(loss).alias("log_loss"), F.avg(hit).alias("accuracy"))


def evaluate(scored: DataFrame, threshold: float = 0.5, hot_rows: int | None = None) -> DataFrame:
    """roc_auc, log_loss, pr_auc and accuracy per model."""
    return (
        loss_metrics(scored, threshold)
        .join(rank_metrics(scored, hot_rows), MODEL, "left")
        .select(MODEL, "roc_auc", "log_loss", "pr_auc", "accuracy")
    )


def model_comparison(metrics: DataFrame, decimals: int = 4) -> DataFrame:
    return metrics.select(
        MODEL, *[F.round(c, decimals).alias(c) for c in ("roc_auc", "log_loss", "pr_auc")]
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the highest ROC-AUC; ties go to the first name."""
    return metrics.orderBy(F.desc("roc_auc"), MODEL).select(MODEL, "roc_auc").limit(1)


def roc_curve(scored: DataFrame, decimals: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """False and true positive rate at every score, from the empty set (threshold infinity) on."""
    ranks = score_ranks(scored, decimals, hot_rows)
    points = ranks.select(
        MODEL,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("t_neg") - F.col("b_neg"), "t_neg").alias("fpr"),
        F.try_divide(F.col("t_pos") - F.col("b_pos"), "t_pos").alias("tpr"),
    )
    origin = scored.select(MODEL).distinct().select(
        MODEL, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def pr_curve(scored: DataFrame, decimals: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """Precision and recall at every score, closed by precision 1 at recall 0."""
    hits = F.col("t_pos") - F.col("b_pos")
    flagged = hits + F.col("t_neg") - F.col("b_neg")
    points = score_ranks(scored, decimals, hot_rows).select(
        MODEL,
        F.col("score").alias("threshold"),
        (hits / flagged).alias("precision"),
        F.try_divide(hits, "t_pos").alias("recall"),
    )
    end = scored.select(MODEL).distinct().select(
        MODEL,
        F.lit(float("inf")).alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def calibration_curve(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score and share of positives per equal bin; an edge belongs to the bin below it."""
    position = F.greatest(F.ceil(F.col("score") * bins), F.lit(1)).cast("int")
    return (
        scored.groupBy(MODEL, position.alias("bin"))
        .agg(
            F.avg("score").alias("mean_predicted"),
            F.avg("label").alias("fraction_positive"),
            F.count(F.lit(1)).alias("count"),
        )
    )


def confusion_counts(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.groupBy(MODEL, F.col("label").alias("actual"), predicted).agg(F.count(F.lit(1)).alias("count"))


def score_histogram(scored: DataFrame, bins: int = 50) -> DataFrame:
    """Score distribution by label."""
    position = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(MODEL, "label", position.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def example_rows(scored: DataFrame, order: Sequence[str] = ("id",), n: int = 20, threshold: float = 0.5) -> DataFrame:
    """The first rows in id order with actual, probability and class."""
    return (
        scored.orderBy(*order)
        .limit(n)
        .select(
            *order,
            F.col("label").alias("actual"),
            F.col("score").alias("predicted_prob"),
            (F.col("score") >= threshold).cast("int").alias("predicted_class"),
        )
    )
