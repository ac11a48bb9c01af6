"""Scoring requests: preparation, validation, encodings, and wording of results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions import temporal
from adlens.operators.normalize import _lookup
from adlens.schemas import DEVICES, PLACEMENTS

MAX_BATCH = 1000


def prepare_requests(df: DataFrame, now: str) -> DataFrame:
    """Fill time fields: a missing timestamp is `now`, missing parts come from the timestamp."""
    ts = F.coalesce(F.col("timestamp"), F.lit(now).cast("timestamp_ntz"))
    dow = F.coalesce(F.col("day_of_week"), F.weekday(ts))
    return df.withColumns(
        {
            "timestamp": ts,
            "hour": F.coalesce(F.col("hour"), F.hour(ts)),
            "day_of_week": dow,
            "is_weekend": temporal.weekend_flag(dow),
            "date": F.to_date(ts),
        }
    )


def ordinal_encode(df: DataFrame) -> DataFrame:
    """device_encoded and placement_encoded; an unknown value counts as the first one."""
    return df.withColumns(
        {
            "device_encoded": _lookup(F.col("device"), {v: i for i, v in enumerate(DEVICES)}, 0),
            "placement_encoded": _lookup(F.col("placement"), {v: i for i, v in enumerate(PLACEMENTS)}, 0),
        }
    )


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the trained columns, in their order; a column the data lacks is 0."""
    return df.select(
        *keep, *[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in features]
    )


def reject_reason(batch_size: str | None = None) -> Column:
    """Why a request is refused, or null."""
    reason = F
    for column in ("user_id", "ad_id", "device", "placement"):
        reason = reason.when(F.col(column).isNull(), f"missing {column}")
    reason = reason.when(~F.col("hour").between(0, 23), "hour out of range")
    reason = reason.when(~F.col("day_of_week").between(0, 6), "day_of_week out of range")
    if batch_size:
        reason = reason.when(~F.col(batch_size).between(1, MAX_BATCH), "batch size out of range")
    return reason.otherwise(F.lit(None).cast("string"))


def validate_requests(df: DataFrame, batch_key: str | None = None) -> DataFrame:
    """Add `reject_reason`; accepted rows have none. With `batch_key`, oversized batches fail."""
    if batch_key is None:
        return df.withColumn("reject_reason", reject_reason())
    sizes = df.groupBy(batch_key).agg(F.count(F.lit(1)).alias("_batch_size"))
    return (
        df.join(sizes, batch_key, "left")
        .withColumn("reject_reason", reject_reason("_batch_size"))
        .drop("_batch_size")
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNotNull())


def classify(df: DataFrame, threshold: float = 0.5, score: str = "predicted_ctr") -> DataFrame:
    return df.withColumn("predicted_class", (F.col(score) >= F.lit(threshold)).cast("int"))


def ctr_band(ctr: Column) -> Column:
    return F.when(ctr < 0.01, "low").when(ctr < 0.05, "moderate").otherwise("high")


def percent_text(fraction: Column) -> Column:
    """A fraction as a percentage with two decimals, rounded half up."""
    points = F.floor(fraction * 10000 + F.lit(0.5)).cast("bigint")
    return F.concat(
        F.floor(points / 100).cast("string"),
        F.lit("."),
        F.lpad((points % 100).cast("string"), 2, "0"),
        F.lit("%"),
    )


# The sentences an explanation is made of.
DEVICE_SENTENCES = {
    "mobile": "Mobile devices typically show higher engagement.",
    "desktop": "Desktop users may be more selective.",
}
PLACEMENT_SENTENCES = {
    "header": "Header placements often receive more visibility.",
    "sidebar": "Sidebar placements may have lower visibility.",
    "popup": "Popup ads can have higher engagement but also higher annoyance.",
}
HOUR_SENTENCES = {
    "business": "Business hours typically show higher engagement.",
    "evening": "Evening hours may have higher user activity.",
    "off_peak": "Off-peak hours may show lower engagement.",
}
BAND_SENTENCES = {
    "low": "This is a relatively low CTR, suggesting limited user interest.",
    "moderate": "This is a moderate CTR, indicating reasonable user interest.",
    "high": "This is a high CTR, suggesting strong user interest.",
}


def explain_prediction(df: DataFrame, importance: Mapping[str, float] | None = None) -> DataFrame:
    """Add `explanation`: the predicted rate, up to three remarks, and the strongest feature."""
    hour = F.col("hour")
    hour_kind = (
        F.when(hour.between(9, 17), "business").when(hour.between(18, 22), "evening")
        .when(hour.isNotNull(), "off_peak")
    )
    remarks = F.array_compact(
        F.array(
            _lookup(F.col("device"), DEVICE_SENTENCES, None),
            _lookup(F.col("placement"), PLACEMENT_SENTENCES, None),
            _lookup(hour_kind, HOUR_SENTENCES, None),
            _lookup(ctr_band(F.col("predicted_ctr")), BAND_SENTENCES, None),
        )
    )
    parts = [
        F.lit("This ad impression has a predicted CTR of **"),
        percent_text(F.col("predicted_ctr")),
        F.lit("**. "),
        F.array_join(F.slice(remarks, 1, 3), " "),
    ]
    if importance:
        name = max(importance, key=lambda k: abs(importance[k]))
        parts.append(
            F.lit(f" The most important factor is **{name}** (importance: {importance[name]:.3f}).")
        )
    return df.withColumn("explanation", F.concat(*parts))


def compare_predictions(df: DataFrame, request: str = "request_id") -> DataFrame:
    """Per request: best and lowest model, their difference, and how to word it.

    Requests scored by fewer than two models have nothing to compare and are left out. Equal
    scores are told apart by model name.
    """
    ctr, name = F.col("predicted_ctr"), F.col("model_name")
    best, worst = F.col("best"), F.col("worst")
    difference = best["ctr"] - worst["ctr"]
    return (
        df.groupBy(request)
        .agg(
            F.count(F.lit(1)).alias("models"),
            # Highest score, then first name: the minimum of (-score, name).
            F.min(F.struct((-ctr).alias("negated"), name.alias("name"), ctr.alias("ctr"))).alias("best"),
            F.max(F.struct((-ctr).alias("negated"), name.alias("name"), ctr.alias("ctr"))).alias("worst"),
        )
        .filter("models >= 2")
        .select(
            request,
            best["name"].alias("best_model"),
            best["ctr"].alias("best_ctr"),
            worst["name"].alias("worst_model"),
            worst["ctr"].alias("worst_ctr"),
            difference.alias("difference"),
            (F.try_divide(difference, best["ctr"]) * 100).alias("relative_pct"),
            F.when(difference > 0.01, "significant").otherwise("moderate").alias("variation"),
            F.when(best["ctr"] > 0.02, "optimistic").otherwise("conservative").alias("tone"),
        )
    )
