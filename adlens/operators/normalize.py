"""Raw click log to the canonical impressions table, and checks on the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions import temporal
from adlens.schemas import DEVICES, IMPRESSION_COLUMNS, PLACEMENTS

# Codes of the raw log.
DEVICE_CODES = {1: "desktop", 2: "mobile", 4: "tablet", 5: "other"}
BANNER_CODES = {0: "header", 1: "sidebar", 2: "footer", 3: "in_content", 4: "popup"}


def _lookup(value: Column, table: Mapping, default) -> Column:
    """A small fixed mapping as a CASE expression."""
    out = F
    for key, label in table.items():
        out = out.when(value == F.lit(key), F.lit(label))
    return out.otherwise(F.lit(default))


def _text(column: str) -> Column:
    """Text of a key; a missing one becomes the word `nan`, so that keys never vanish."""
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def normalise_target(df: DataFrame) -> DataFrame:
    """`click` becomes the integer column `clicked`."""
    if "click" not in df.columns:
        return df
    return df.withColumn("clicked", F.col("click").cast("int")).drop("click")


def normalise_hour(df: DataFrame) -> DataFrame:
    """`hour` (YYMMDDHH) becomes `timestamp` plus its calendar columns."""
    if "hour" not in df.columns:
        return df
    parsed = df.withColumn("timestamp", temporal.parse_log_hour(F.col("hour")))
    return parsed.withColumns(temporal.calendar(F.col("timestamp")))


def add_calendar(df: DataFrame) -> DataFrame:
    """hour, day_of_week, is_weekend and date from `timestamp`."""
    return df.withColumns(temporal.calendar(F.col("timestamp")))


def normalise_device(df: DataFrame) -> DataFrame:
    if "device_type" not in df.columns:
        return df
    return df.withColumn("device", _lookup(F.col("device_type"), DEVICE_CODES, "other"))


def normalise_placement(df: DataFrame) -> DataFrame:
    if "banner_pos" not in df.columns:
        return df
    position = F.pmod(F.col("banner_pos"), F.lit(len(BANNER_CODES)))
    return df.withColumn("placement", _lookup(position, BANNER_CODES, "other"))


def composite_user(df: DataFrame) -> DataFrame:
    if not {"device_id", "device_ip"} <= set(df.columns):
        return df
    return df.withColumn("user_id", F.concat_ws("_", _text("device_id"), _text("device_ip")))


def pick_ad_id(df: DataFrame) -> DataFrame:
    source = next((c for c in ("C14", "C1") if c in df.columns), None)
    return df if source is None else df.withColumn("ad_id", _text(source))


def reorder_standard(df: DataFrame, first: Sequence[str] = IMPRESSION_COLUMNS) -> DataFrame:
    """Canonical columns first, the others after them."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def normalise_log(df: DataFrame) -> DataFrame:
    """All normalisation steps; a step whose input column is missing is skipped."""
    for step in (
        normalise_target,
        normalise_hour,
        normalise_device,
        normalise_placement,
        composite_user,
        pick_ad_id,
        reorder_standard,
    ):
        df = df.transform(step)
    return df


def temporal_features(df: DataFrame) -> DataFrame:
    """month, day, ISO week, business hours and part of the day."""
    ts, hour = F.col("timestamp"), F.col("hour")
    return df.withColumns(
        {
            "month": F.month(ts),
            "day": F.dayofmonth(ts),
            "week_of_year": F.weekofyear(ts),
            "is_business_hours": temporal.business_hours(hour),
            "time_of_day": temporal.time_of_day(hour),
        }
    )


def cyclical_time(df: DataFrame) -> DataFrame:
    return df.withColumns(
        temporal.cyclical(F.col("hour"), 24, "hour")
        | temporal.cyclical(F.col("day_of_week"), 7, "day_of_week")
    )


def interaction_key(df: DataFrame, a: str = "device", b: str = "placement") -> DataFrame:
    return df.withColumn(f"{a}_{b}", F.concat_ws("_", _text(a), _text(b)))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def select_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    return df.select(*numeric_columns(df, exclude))


def filter_clicked(df: DataFrame, target: str = "clicked") -> DataFrame:
    return df.filter(F.col(target) == 1)


def filter_recent(df: DataFrame, reference: str, days: int = 0, hours: int = 0) -> DataFrame:
    """Rows of the last days and hours before a reference time given by the caller."""
    start = F.lit(reference).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days), F.lit(hours))
    return df.filter(F.col("timestamp") >= start)


def quality_checks(df: DataFrame) -> DataFrame:
    """One row of violation counts and value ranges.

    Repeated rows are found by a 256-bit digest of each; only digests are shuffled.
    """
    micros = {f"timestamp{kind}Format": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" for kind in ("", "NTZ")}
    # Zero with and without a sign is one value.
    values = [(F.col(c) + 0.0).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    digest = F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false", **micros}), 256)
    distinct = df.groupBy(F.unhex(digest).alias("_row")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = distinct.agg((F.sum("_n") - F.count(F.lit(1))).alias("duplicate_rows"))

    def violations(bad: Column) -> Column:
        return F.count_if(F.coalesce(bad, F.lit(True)))

    rest = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        violations(~F.col("clicked").isin(0, 1)).alias("bad_clicked"),
        violations(~F.col("device").isin(DEVICES)).alias("bad_device"),
        violations(~F.col("placement").isin(PLACEMENTS)).alias("bad_placement"),
        violations(~F.col("hour").between(0, 23)).alias("bad_hour"),
        F.min("user_id").alias("min_user_id"),
        F.max("user_id").alias("max_user_id"),
        F.min("ad_id").alias("min_ad_id"),
        F.max("ad_id").alias("max_ad_id"),
        F.min("hour").alias("min_hour"),
        F.max("hour").alias("max_hour"),
    )
    # Size bound: both sides are one row.
    return rest.crossJoin(F.broadcast(repeated))
