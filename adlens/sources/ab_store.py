"""A/B test configurations and counters kept as JSON maps, and their tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from adlens.schemas import AB_METRIC, AB_TEST


def parse_tests(documents: DataFrame, column: str = "value") -> DataFrame:
    """One row per test from documents `{test_id: config}`."""
    parsed = documents.select(F.from_json(column, MapType(StringType(), AB_TEST)).alias("m"))
    config = parsed.select(F.explode("m").alias("key", "c")).select("c.*")
    return config.withColumns(
        {c: F.col(c).try_cast("timestamp_ntz") for c in ("start_time", "end_time")}
    )


def parse_metrics(documents: DataFrame, column: str = "value") -> DataFrame:
    """One row per test and model from documents `{test_id: {model: counters}}`.

    An absent minimum means that nothing was measured yet: infinity.
    """
    nested = MapType(StringType(), MapType(StringType(), AB_METRIC))
    parsed = documents.select(F.from_json(column, nested).alias("m"))
    per_test = parsed.select(F.explode("m").alias("test", "models"))
    return per_test.select(F.explode("models").alias("model", "c")).select("c.*").withColumns(
        {
            "min_prediction_time_ms": F.coalesce("min_prediction_time_ms", F.lit(float("inf"))),
            "last_updated": F.col("last_updated").try_cast("timestamp_ntz"),
        }
    )


def load_ab_tests(spark: SparkSession, path: str) -> DataFrame:
    return parse_tests(spark.read.text(path, wholetext=True))


def load_ab_metrics(spark: SparkSession, path: str) -> DataFrame:
    return parse_metrics(spark.read.text(path, wholetext=True))


def save_ab_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
