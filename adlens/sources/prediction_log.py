"""The prediction log and the training table: rows, layout, appends and reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.schemas import PREDICTION_COLUMNS, TRAINING_COLUMNS


def prediction_rows(scored: DataFrame, logged_at: str | None = None) -> DataFrame:
    """Log rows of scored requests: id, time, JSON of the request's time fields, outcome if known.

    A request that could not be scored keeps its null rate; the reason, where given, is in the JSON.

    A row keeps its request id; one without gets a random id. `logged_at` fixes the log time.
    """
    present = set(scored.columns)
    now = F.lit(logged_at) if logged_at else F.current_timestamp()
    fields = [F.col(c) for c in ("hour", "day_of_week", "timestamp", "score_error") if c in present]
    request_id = F.coalesce(F.col("request_id").cast("string"), F.uuid()) if "request_id" in present else F.uuid()

    def text(column: str, default: str) -> Column:
        value = F.col(column).cast("string") if column in present else F.lit(None).cast("string")
        return F.coalesce(value, F.lit(default)).alias(column)

    return scored.select(
        text("user_id", ""),
        text("ad_id", ""),
        text("device", ""),
        text("placement", ""),
        F.col("predicted_ctr").cast("double").alias("predicted_ctr"),
        (F.col("actual_ctr").cast("double") if "actual_ctr" in present else F.lit(None).cast("double")).alias("actual_ctr"),
        now.cast("timestamp_ntz").alias("timestamp"),
        text("model_name", "unknown"),
        request_id.alias("request_id"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("features"),
    ).select(*PREDICTION_COLUMNS)


def combine_batch(requests: DataFrame, scores: DataFrame, actuals: DataFrame | None = None) -> DataFrame:
    """Requests, their scores and known outcomes, matched by request id rather than by position."""
    out = requests.join(scores, "request_id")
    if actuals is not None:
        out = out.join(actuals.select("request_id", "actual_ctr"), "request_id", "left")
    return out


def training_rows(df: DataFrame, target: str = "clicked") -> DataFrame:
    """Training table rows: boolean label, remaining columns as JSON."""
    base = {"user_id", "ad_id", "device", "placement", "timestamp", target, "date"}
    extra = [c for c in df.columns if c not in base]
    return df.select(
        *[F.col(c).cast("string").alias(c) for c in ("user_id", "ad_id", "device", "placement")],
        (F.col(target) == 1).alias("clicked"),
        "timestamp",
        F.to_json(F.struct(*extra), {"ignoreNullFields": "false"}).alias("features"),
    ).select(*TRAINING_COLUMNS)


def write_by_day(df: DataFrame, path: str, cluster: tuple[str, ...] = (), mode: str = "append") -> None:
    """Day-partitioned parquet, clustered by the given columns.

    Rows are range-partitioned by day, cluster columns and a hash of the row: a day gets as many
    files as its size asks for, a heavy day or model is divided among tasks, and each file covers
    few models and devices, which lets readers skip it.
    """
    dated = df.withColumn("date", F.to_date("timestamp"))
    spread = F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")])
    ordered = dated.repartitionByRange("date", *cluster, spread).sortWithinPartitions("date", *cluster)
    ordered.write.mode(mode).partitionBy("date").parquet(path)


@dataclass(frozen=True)
class LogReport:
    """What a batch wrote: rows in all, of them rows without a rate, and rows whose outcome is known."""

    logged: int
    refused: int
    with_actual: int


def log_batch(rows: DataFrame, path: str, batch: str) -> LogReport:
    """Write the log rows of a batch into their day folders and report what was written.

    A batch that is written again replaces itself (its folders, day by day) and no other. The rows are computed once:
    the report reads two columns of the files just written, so it counts what is there however often a task was tried.
    (An observed metric would save that read, but a session that has one can no longer run models fitted in it.)
    """
    dated = rows.withColumns({"date": F.to_date("timestamp"), "batch": F.lit(batch)})
    spread = F.xxhash64("request_id")
    ordered = dated.repartitionByRange("date", "model_name", spread).sortWithinPartitions("date", "model_name")
    writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date", "batch").parquet(path)
    written = rows.sparkSession.read.schema(ordered.schema).parquet(path).filter(F.col("batch") == batch)
    counts = written.agg(
        F.count(F.lit(1)).alias("logged"),
        F.count_if(F.col("predicted_ctr").isNull()).alias("refused"),
        F.count("actual_ctr").alias("with_actual"),
    )
    return LogReport(**counts.first().asDict())


def append_predictions(rows: DataFrame, path: str) -> None:
    write_by_day(rows, path, cluster=("model_name", "device"))


def append_training(rows: DataFrame, path: str) -> None:
    write_by_day(rows, path)


def read_log(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The log from a day on; the filter on the partition column skips older folders."""
    df = spark.read.parquet(path)
    return df.filter(F.col("date") >= F.lit(since).cast("date")) if since else df


def user_predictions(log: DataFrame, user_id: str) -> DataFrame:
    return log.filter(F.col("user_id") == user_id)
