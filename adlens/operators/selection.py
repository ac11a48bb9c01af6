"""Feature selection by variance, correlation and forest importance.

Each step reads the rows with one or two aggregates and takes only column statistics to the driver;
the rows themselves are never rewritten, a selection is a list of columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations
from math import isnan

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.operators.comoments import co_moments
from adlens.operators.normalize import numeric_columns

TARGET = "clicked"
PAIR_SCHEMA = "feature_1 string, feature_2 string, correlation double"


def _finite(column: str) -> Column:
    """The value as a double; NaN and infinities count as missing."""
    v = F.col(column).cast("double")
    return F.when(F.isnan(v) | v.isin(float("inf"), float("-inf")), None).otherwise(v)


def variance_report(df: DataFrame, threshold: float = 0.01, target: str = TARGET) -> DataFrame:
    """Population variance per numeric column and whether it passes.

    A missing or infinite value counts as twice the largest magnitude of the maximum, at least a
    million. The variance with those fills follows from the moments of the present values, so one
    pass is enough.
    """
    columns = numeric_columns(df, [target])
    stats = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count(_finite(c)).alias("n"),
            (F.count(F.lit(1)) - F.count(_finite(c))).alias("absent"),
            F.avg(_finite(c)).alias("mean"),
            F.var_pop(_finite(c)).alias("var"),
            F.max(_finite(c)).alias("top"),
        ).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]
    rows = df.agg(*stats).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(columns))])))
    n, absent, top = F.col("n"), F.col("absent"), F.col("top")
    fill = F.when(top.isNull(), 1e6).otherwise(F.greatest(F.abs(top) * 2, F.lit(1e6)))
    total = n + absent
    gap = F.col("mean") - fill
    spread = n * F.col("var") + F.try_divide(n * absent * gap * gap, total)
    variance = F.when(absent == 0, F.col("var")).when(n == 0, 0.0).otherwise(spread / total)
    return rows.select("feature", variance.alias("variance")).withColumn("keep", F.col("variance") > threshold)


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None, target: str = TARGET) -> DataFrame:
    """Absolute Pearson correlation of every pair of numeric columns, over rows that have both.

    One scan for all pairs, with gaps or without. A column that is constant over the common rows has no correlation:
    null. NaN and infinities count as missing, as for the variance.
    """
    columns = list(columns or numeric_columns(df, [target]))
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], PAIR_SCHEMA)
    r = co_moments(df, [_finite(c) for c in columns]).correlations()
    rows = [(a, b, None if isnan(r[i, j]) else abs(float(r[i, j]))) for (i, a), (j, b) in combinations(enumerate(columns), 2)]
    return df.sparkSession.createDataFrame(rows, PAIR_SCHEMA)


def high_correlation_report(df: DataFrame, threshold: float = 0.95, target: str = TARGET) -> DataFrame:
    """Columns to drop: those correlated above the threshold with any earlier column."""
    return (
        correlation_pairs(df, target=target)
        .groupBy(F.col("feature_2").alias("feature"))
        .agg(F.max("correlation").alias("max_correlation"))
        .filter(F.col("max_correlation") > threshold)
    )


def correlated_pairs(df: DataFrame, threshold: float = 0.9, columns: Sequence[str] | None = None) -> DataFrame:
    return correlation_pairs(df, columns).filter(F.col("correlation") > threshold)


def low_variance_columns(df: DataFrame, threshold: float = 0.01, target: str = TARGET) -> list[str]:
    if not numeric_columns(df, [target]):
        return []
    report = variance_report(df, threshold, target).filter(~F.coalesce("keep", F.lit(False)))
    return [r["feature"] for r in report.collect()]


def high_correlation_columns(df: DataFrame, threshold: float = 0.95, target: str = TARGET) -> list[str]:
    if len(numeric_columns(df, [target])) < 2:
        return []
    return [r["feature"] for r in high_correlation_report(df, threshold, target).collect()]


def importance_ranking(
    df: DataFrame,
    columns: Sequence[str],
    target: str = TARGET,
    trees: int = 50,
    max_depth: int = 10,
    seed: int = 42,
) -> list[tuple[str, float]]:
    """Numeric columns by importance in a random forest, strongest first."""
    from pyspark.ml.classification import RandomForestClassifier

    from adlens.operators.models import assemble

    forest = RandomForestClassifier(
        labelCol=target, featuresCol="features", numTrees=trees, maxDepth=max_depth, seed=seed
    )
    model = forest.fit(assemble(df, columns).select("features", F.col(target).cast("double").alias(target)))
    scores = model.featureImportances.toArray()
    return sorted(((c, float(s)) for c, s in zip(columns, scores)), key=lambda p: (-p[1], p[0]))


@dataclass
class Selection:
    """Columns that stay, in order, and why each other one left."""

    kept: list[str]
    dropped: dict[str, str] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        """The kept columns; the target may be absent in data to score."""
        return df.select(*[c for c in self.kept if c in df.columns])


def select_features(
    df: DataFrame,
    target: str = TARGET,
    protect: Sequence[str] = (),
    remove_low_variance: bool = True,
    remove_correlated: bool = True,
    by_importance: bool = False,
    n_features: int | None = None,
) -> Selection:
    """Variance, then correlation, then (only if asked, and a number is given) importance."""
    dropped: dict[str, str] = {}

    def remaining() -> DataFrame:
        return df.select(*[c for c in df.columns if c not in dropped and c not in protect])

    if remove_low_variance:
        dropped |= dict.fromkeys(low_variance_columns(remaining(), target=target), "low variance")
    if remove_correlated:
        dropped |= dict.fromkeys(high_correlation_columns(remaining(), target=target), "correlated")
    if by_importance and n_features and target in df.columns:
        numeric = numeric_columns(remaining(), [target])
        if numeric:
            ranked = importance_ranking(df, numeric, target)
            dropped |= {c: "low importance" for c, _ in ranked[n_features:]}
    return Selection([c for c in df.columns if c not in dropped], dropped)
