"""Schemas of the canonical tables."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_LOG = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("click", T.IntegerType()),
        T.StructField("hour", T.StringType()),
        T.StructField("C1", T.IntegerType()),
        T.StructField("banner_pos", T.IntegerType()),
        T.StructField("site_id", T.StringType()),
        T.StructField("site_domain", T.StringType()),
        T.StructField("site_category", T.StringType()),
        T.StructField("app_id", T.StringType()),
        T.StructField("app_domain", T.StringType()),
        T.StructField("app_category", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("device_ip", T.StringType()),
        T.StructField("device_model", T.StringType()),
        T.StructField("device_type", T.IntegerType()),
        T.StructField("device_conn_type", T.IntegerType()),
        *[T.StructField(f"C{i}", T.IntegerType()) for i in range(14, 22)],
    ]
)

IMPRESSION_COLUMNS = [
    "user_id",
    "ad_id",
    "device",
    "placement",
    "timestamp",
    "hour",
    "day_of_week",
    "is_weekend",
    "date",
    "clicked",
]

PREDICTION_COLUMNS = [
    "user_id",
    "ad_id",
    "device",
    "placement",
    "predicted_ctr",
    "actual_ctr",
    "timestamp",
    "model_name",
    "request_id",
    "features",
]

TRAINING_COLUMNS = ["user_id", "ad_id", "device", "placement", "clicked", "timestamp", "features"]

AB_TEST = T.StructType(
    [
        T.StructField("test_id", T.StringType()),
        T.StructField("model_a", T.StringType()),
        T.StructField("model_b", T.StringType()),
        T.StructField("traffic_split", T.DoubleType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("enabled", T.BooleanType()),
        T.StructField("description", T.StringType()),
    ]
)

AB_METRIC = T.StructType(
    [
        T.StructField("test_id", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("total_requests", T.LongType()),
        T.StructField("total_predictions", T.LongType()),
        T.StructField("avg_prediction_time_ms", T.DoubleType()),
        T.StructField("total_prediction_time_ms", T.DoubleType()),
        T.StructField("min_prediction_time_ms", T.DoubleType()),
        T.StructField("max_prediction_time_ms", T.DoubleType()),
        T.StructField("error_count", T.LongType()),
        T.StructField("last_updated", T.StringType()),
    ]
)

# The devices and placements an impression may carry.
DEVICES = ["mobile", "desktop", "tablet"]
PLACEMENTS = ["header", "sidebar", "footer", "in_content", "popup"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
