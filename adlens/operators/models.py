"""Click models with Spark ML: training, scoring, importances and calibration."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.operators.leafwise import LeafwiseModel, LeafwiseTrainer, Options
from adlens.sources.materialise import materialise

TARGET = "clicked"
DEFAULT_CTR = 0.02


def known_value(column: str) -> Column:
    """The column as a number; null and NaN count as 0, in training and in evaluation alike."""
    return F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(0.0)), F.lit(0.0))


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Vector of the feature columns; a missing value counts as 0."""
    filled = df.withColumns({c: known_value(c) for c in features})
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return assembler.transform(filled)


def _weighted(df: DataFrame, target: str) -> DataFrame:
    """Weight of positives that balances the classes, on every row."""
    ratio = df.agg(F.try_divide(F.count_if(F.col(target) == 0), F.count_if(F.col(target) == 1)).alias("_ratio"))
    # Size bound: one row.
    weighted = df.crossJoin(F.broadcast(ratio))
    return weighted.withColumn(
        "_weight", F.when(F.col(target) == 1, F.coalesce("_ratio", F.lit(1.0))).otherwise(1.0)
    ).drop("_ratio")


def _training_rows(df: DataFrame, features: Sequence[str], target: str, *extra: str) -> DataFrame:
    rows = _weighted(assemble(df, features), target)
    return rows.select("features", F.col(target).cast("double").alias("label"), "_weight", *extra)


#: Rows of a partition of a table that a fit reads over and over or keeps in memory, and those worth a task.
FIT_ROWS, LEAST_ROWS = 500_000, 20_000


def _even(rows: DataFrame) -> DataFrame:
    """The rows in partitions of one size, none over `FIT_ROWS`: a fit takes as long as its largest partition, which
    is as uneven as the files or keys the rows come from."""
    n = rows.count()
    parts = max(-(-n // FIT_ROWS), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_ROWS)), 1)
    return rows.repartition(parts)


def train_logistic(
    df: DataFrame, features: Sequence[str], target: str = TARGET, max_iter: int = 1000
) -> PipelineModel:
    """Standardised features, balanced classes, L-BFGS."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    model = LogisticRegression(
        featuresCol="scaled", labelCol="label", weightCol="_weight", maxIter=max_iter, regParam=1e-6,
        standardization=False,
    )
    return Pipeline(stages=[scaler, model]).fit(_training_rows(df, features, target))


def train_gbt(
    df: DataFrame,
    features: Sequence[str],
    target: str = TARGET,
    max_depth: int = 6,
    step_size: float = 0.1,
    rounds: int = 100,
    subsample: float = 0.8,
    column_sample: float = 0.8,
    validation: str | None = None,
    patience: int = 10,
    seed: int = 42,
) -> Model:
    """Boosted trees of `rounds` rounds.

    With a boolean `validation` column the rows it marks are held out and the best round on them is kept:
    the search ends once `patience` rounds bring no better one, and the model is fitted again with that
    many rounds and the same seed. The library's own stop waits for no later round, so it is not used.
    """
    booster = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="_weight", maxDepth=max_depth,
        stepSize=step_size, maxIter=rounds, subsamplingRate=subsample,
        featureSubsetStrategy=str(column_sample), seed=seed,
    )
    if not validation:
        return booster.fit(_even(materialise(_training_rows(df, features, target), "boosting")))
    marked = F.coalesce(F.col(validation), F.lit(False))
    rows = materialise(_training_rows(df, features, target, marked.alias("_held")), "boosting")
    train = _even(rows.filter("NOT _held"))
    model = booster.fit(train)
    losses = model.evaluateEachIteration(rows.filter("_held"))
    best = best_round(losses, patience)
    return model if best == len(losses) else booster.copy({booster.maxIter: best}).fit(train)


def best_round(losses: Sequence[float], patience: int) -> int:
    """Rounds up to the smallest loss found before `patience` rounds in a row bring no smaller one.

    With no held-out rows the losses are not numbers; then all rounds are kept.
    """
    best = 0
    for k, loss in enumerate(losses):
        if math.isnan(loss):
            return len(losses)
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def train_gbt_leaf(
    df: DataFrame,
    features: Sequence[str],
    target: str = TARGET,
    validation: str | None = None,
    row_id: str | None = None,
    **options,
) -> LeafwiseModel:
    """Second booster profile: trees of at most 31 leaves, the leaf with the largest gain split first.

    `options` are those of `leafwise.Options`. With a boolean `validation` column the rounds up to the best one on the
    rows it marks are kept, once `patience` rounds brought no better one. Rows of a round are drawn by `row_id`, or
    by their place in the written training table if none is given.
    """
    held = F.coalesce(F.col(validation), F.lit(False)) if validation else F.lit(False)
    key = F.xxhash64(row_id) if row_id else F.monotonically_increasing_id()
    rows = _training_rows(df.withColumns({"_held": held, "_key": key}), features, target, "_held", "_key")
    return LeafwiseTrainer(rows, len(features), Options(**options)).fit()


TRAINERS = {"logistic": train_logistic, "xgboost": train_gbt, "lightgbm": train_gbt_leaf}


def score_batch(
    df: DataFrame,
    models: Mapping[str, Model],
    features: Sequence[str],
    model_name: str = "xgboost",
    default_ctr: float | None = None,
) -> DataFrame:
    """Add predicted_ctr, model_name and score_error.

    A row with a feature that is null, NaN or infinite is not scored: its rate is null (or
    `default_ctr` if the caller asks for one) and `score_error` says why.
    """
    if model_name not in models:
        raise ValueError(f"model {model_name!r} is not loaded; available: {sorted(models)}")
    unusable = F.lit(False)
    for c in features:
        v = F.col(c).cast("double")
        unusable = unusable | v.isNull() | F.isnan(v) | v.isin(float("inf"), float("-inf"))
    flagged = df.withColumn("_unusable", unusable)
    clean = {
        c: F.when(F.col("_unusable"), 0.0).otherwise(F.col(c).cast("double")).alias(f"_f_{c}") for c in features
    }
    vectors = VectorAssembler(inputCols=[f"_f_{c}" for c in features], outputCol="features").transform(
        flagged.select("*", *clean.values())
    )
    scored = models[model_name].transform(vectors)
    probability = vector_to_array("probability")[1]
    fallback = F.lit(default_ctr).cast("double")
    return scored.select(
        *df.columns,
        F.when(F.col("_unusable"), fallback).otherwise(probability).alias("predicted_ctr"),
        F.lit(model_name).alias("model_name"),
        F.when(F.col("_unusable"), "unusable feature value").alias("score_error"),
    )


def compare_models(df: DataFrame, models: Mapping[str, Model], features: Sequence[str]) -> DataFrame:
    """Every model's score of the same requests, as rows."""
    parts = [score_batch(df, models, features, name) for name in models]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def feature_importance(model: Model, features: Sequence[str], df: DataFrame, n: int = 20) -> DataFrame:
    """Strongest features of a tree model; `df` only supplies the session."""
    scores = [(f, float(s)) for f, s in zip(features, model.featureImportances.toArray())]
    top = sorted(scores, key=lambda p: (-p[1], p[0]))[:n]
    return df.sparkSession.createDataFrame(top, "feature string, importance double")


def fit_platt(scored: DataFrame) -> Model:
    """Logistic curve from score to outcome frequency."""
    rows = scored.select("score", F.col("label").cast("double").alias("label"))
    vectors = VectorAssembler(inputCols=["score"], outputCol="features").transform(rows)
    return LogisticRegression(featuresCol="features", labelCol="label").fit(vectors)


def apply_platt(model: Model, scored: DataFrame) -> DataFrame:
    vectors = VectorAssembler(inputCols=["score"], outputCol="features").transform(scored)
    out = model.transform(vectors)
    return out.select(*scored.columns, vector_to_array("probability")[1].alias("calibrated"))


def fit_isotonic(scored: DataFrame, decimals: int = 4) -> Model:
    """Monotone curve from score to outcome frequency.

    Scores are rounded and tied ones merged to weighted means first, so that the fit, which ends
    in one task, sees at most 10**decimals + 1 points however many rows there are.
    """
    points = (
        scored.groupBy(F.round("score", decimals).alias("score"))
        .agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    )
    return IsotonicRegression(featuresCol="score", labelCol="label", weightCol="weight").fit(points)


def apply_isotonic(model: Model, scored: DataFrame) -> DataFrame:
    return model.transform(scored).select(*scored.columns, F.col("prediction").alias("calibrated"))


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One vector column `{c}_onehot` per category column of low cardinality."""
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_index" for c in columns],
        stringOrderType="alphabetAsc", handleInvalid="keep",
    )
    encoder = OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_onehot" for c in columns])
    encoded = Pipeline(stages=[indexer, encoder]).fit(df).transform(df)
    return encoded.drop(*[f"{c}_index" for c in columns])


def grid_search_logistic(
    df: DataFrame, features: Sequence[str], target: str = TARGET,
    reg_params: Sequence[float] = (0.0, 0.01, 0.1), folds: int = 3, seed: int = 42, max_iter: int = 50,
) -> tuple[Model, list[tuple[float, float]]]:
    """Regularisation chosen by cross-validated ROC-AUC; returns the model and (value, AUC) pairs."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    model = LogisticRegression(featuresCol="features", labelCol="label", weightCol="_weight", maxIter=max_iter)
    grid = ParamGridBuilder().addGrid(model.regParam, list(reg_params)).build()
    search = CrossValidator(
        estimator=model, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(),
        numFolds=folds, seed=seed, parallelism=2,
    )
    fitted = search.fit(_training_rows(df, features, target))
    return fitted.bestModel, list(zip(reg_params, fitted.avgMetrics))
