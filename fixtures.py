"""Input tables of the checks, derived from the given parquet tables, in Spark and in DuckDB SQL.

Every Spark function here has a DuckDB twin in `CTE`; the twins give equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.operators.abtest import bucket_of

NOW = "2024-01-20 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def impressions_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS impression_id",
        "user_id",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS ad_id",
        """CASE WHEN event_id % 10 < 5 THEN 'mobile' WHEN event_id % 10 < 8 THEN 'desktop'
           ELSE 'tablet' END AS device""",
        """CASE WHEN (event_id div 10) % 10 < 2 THEN 'header' WHEN (event_id div 10) % 10 < 4 THEN 'sidebar'
           WHEN (event_id div 10) % 10 < 6 THEN 'footer' WHEN (event_id div 10) % 10 < 9 THEN 'in_content'
           ELSE 'popup' END AS placement""",
        "CAST(ts AS TIMESTAMP_NTZ) AS timestamp",
        "CAST(hour(ts) AS INT) AS hour",
        "CAST(weekday(ts) AS INT) AS day_of_week",
        "CASE WHEN weekday(ts) >= 5 THEN 1 ELSE 0 END AS is_weekend",
        "CAST(ts AS DATE) AS date",
        "CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicked",
    )


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impressions_of(table(spark, sf_dir, "events"))


def predictions_of(events: DataFrame) -> DataFrame:
    bucketed = events.withColumn("bucket", bucket_of(F.lit("t1"), F.col("user_id")))
    return bucketed.selectExpr(
        "event_id AS request_id",
        "user_id",
        "bucket",
        "CASE WHEN bucket < 5000 THEN 'xgboost' ELSE 'logistic' END AS model_name",
        "value / 1000.0D AS predicted_ctr",
        "CASE event_type WHEN 'click' THEN 1.0D WHEN 'view' THEN 0.0D END AS actual_ctr",
        "value AS latency_ms",
        "event_type = 'error' AS error",
        "CAST(ts AS TIMESTAMP_NTZ) AS timestamp",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions_of(table(spark, sf_dir, "events"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with outcome; two-decimal values in thousandths, so there are ties."""
    return (
        predictions(spark, sf_dir)
        .filter(F.col("actual_ctr").isNotNull())
        .select(
            F.col("request_id").alias("id"),
            "model_name",
            F.col("actual_ctr").cast("int").alias("label"),
            F.col("predicted_ctr").alias("score"),
        )
    )


def raw_log_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS id",
        "CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS click",
        """CASE WHEN event_id % 97 = 0 THEN 'bad' WHEN event_id % 89 = 0 THEN NULL
           WHEN event_id % 83 = 0 THEN '24139901' WHEN event_id % 79 = 0 THEN '5010112'
           ELSE date_format(ts, 'yyMMddHH') END AS hour""",
        "CAST(1000 + event_id % 7 AS INT) AS C1",
        "CAST(CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_id % 7 END AS INT) AS banner_pos",
        "CAST(CASE WHEN event_id % 103 = 0 THEN NULL ELSE event_id % 6 END AS INT) AS device_type",
        "CASE WHEN event_id % 107 = 0 THEN NULL ELSE concat('d', user_id) END AS device_id",
        "concat('ip', user_id % 17) AS device_ip",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS C14",
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_log_of(table(spark, sf_dir, "events"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests with gaps and values out of range."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS request_id",
        "event_id div 700 AS batch_id",
        "CASE WHEN event_id % 61 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS user_id",
        "regexp_extract(props, '([0-9]+)', 1) AS ad_id",
        "CASE event_id % 5 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' WHEN 2 THEN 'tablet' WHEN 3 THEN 'watch' ELSE NULL END AS device",
        "CASE event_id % 7 WHEN 0 THEN 'header' WHEN 1 THEN 'sidebar' WHEN 2 THEN 'footer' WHEN 3 THEN 'in_content' WHEN 4 THEN 'popup' ELSE 'wall' END AS placement",
        "CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP_NTZ) END AS timestamp",
        "CAST(CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 26 END AS INT) AS hour",
        "CAST(CASE WHEN event_id % 3 <> 1 THEN NULL ELSE event_id % 8 END AS INT) AS day_of_week",
    )


def ab_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One test per supplier; some are invalid, some disabled, some expired."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('t', s_suppkey) AS test_id",
        "'logistic' AS model_a",
        "CASE s_nationkey % 3 WHEN 0 THEN 'lightgbm' ELSE 'xgboost' END AS model_b",
        "s_acctbal / 9000.0D AS traffic_split",
        "timestampadd(DAY, CAST(s_suppkey % 20 AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00') AS start_time",
        """CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE timestampadd(HOUR, CAST((s_suppkey % 20) * 24 + (s_suppkey * 7) % 500 + 1 AS INT),
           TIMESTAMP_NTZ '2024-01-01 00:00:00') END AS end_time""",
        "s_suppkey % 5 <> 0 AS enabled",
        "s_name AS description",
    )


def ab_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction log spread over ten tests."""
    return predictions(spark, sf_dir).withColumn("test_id", F.concat(F.lit("t"), (F.col("user_id") % 10).cast("string")))


def ab_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests naming the test of their user; some name a test that does not exist."""
    return predictions(spark, sf_dir).select(
        "request_id", F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("test_id"),
        "user_id", "latency_ms", "error", "timestamp",
    )


def baseline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten days, before drift is looked for."""
    return predictions(spark, sf_dir).filter("timestamp < TIMESTAMP_NTZ '2024-01-11 00:00:00'")


def line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger labelled table: line items, the target being a return."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS impression_id",
        "l_partkey AS user_id",
        "l_suppkey AS ad_id",
        "l_linestatus AS device",
        "CAST(l_shipdate AS TIMESTAMP_NTZ) AS timestamp",
        "l_quantity AS quantity",
        "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS clicked",
    )


_MD5 = "CAST((((('0x'||substr({m},1,16))::UBIGINT::HUGEINT % {n}) * {k} + ('0x'||substr({m},17,16))::UBIGINT::HUGEINT % {n}) % {n}) AS INT)"


def sql_md5_mod(text: str, n: int) -> str:
    """DuckDB: the md5 of a text modulo n, from its two 64-bit halves."""
    return _MD5.format(m=f"md5({text})", n=n, k=2**64 % n)


def sql_hash_bucket(text: str, n: int) -> str:
    """DuckDB: bucket from the first 60 bits of the md5."""
    return f"CAST((('0x'||substr(md5({text}),1,15))::UBIGINT % {n}) AS INT)"


CTE = {
    "impressions": """SELECT event_id AS impression_id, user_id,
  CAST(regexp_extract(props,'([0-9]+)',1) AS INT) AS ad_id,
  CASE WHEN event_id % 10 < 5 THEN 'mobile' WHEN event_id % 10 < 8 THEN 'desktop' ELSE 'tablet' END AS device,
  CASE WHEN (event_id // 10) % 10 < 2 THEN 'header' WHEN (event_id // 10) % 10 < 4 THEN 'sidebar'
       WHEN (event_id // 10) % 10 < 6 THEN 'footer' WHEN (event_id // 10) % 10 < 9 THEN 'in_content' ELSE 'popup' END AS placement,
  ts AS timestamp, CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts)-1 AS INT) AS day_of_week,
  CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend, CAST(ts AS DATE) AS date,
  CASE WHEN event_type='click' THEN 1 ELSE 0 END AS clicked
FROM events""",
    "predictions": f"""SELECT event_id AS request_id, user_id, bucket,
  CASE WHEN bucket < 5000 THEN 'xgboost' ELSE 'logistic' END AS model_name,
  value/1000.0::DOUBLE AS predicted_ctr,
  CASE event_type WHEN 'click' THEN 1.0::DOUBLE WHEN 'view' THEN 0.0::DOUBLE END AS actual_ctr,
  value AS latency_ms, event_type='error' AS error, ts AS timestamp
FROM (SELECT *, {sql_md5_mod("'t1:'||user_id", 10000)} AS bucket FROM events)""",
    "scored": """SELECT request_id AS id, model_name, CAST(actual_ctr AS INT) AS label, predicted_ctr AS score
FROM predictions WHERE actual_ctr IS NOT NULL""",
    "raw_log": """SELECT event_id AS id, CASE WHEN event_type='click' THEN 1 ELSE 0 END AS click,
  CASE WHEN event_id % 97 = 0 THEN 'bad' WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN '24139901'
       WHEN event_id % 79 = 0 THEN '5010112' ELSE strftime(ts, '%y%m%d%H') END AS hour,
  CAST(1000 + event_id % 7 AS INT) AS C1,
  CAST(CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_id % 7 END AS INT) AS banner_pos,
  CAST(CASE WHEN event_id % 103 = 0 THEN NULL ELSE event_id % 6 END AS INT) AS device_type,
  CASE WHEN event_id % 107 = 0 THEN NULL ELSE concat('d', user_id) END AS device_id,
  concat('ip', user_id % 17) AS device_ip,
  CAST(regexp_extract(props,'([0-9]+)',1) AS INT) AS C14
FROM events""",
    "requests": """SELECT event_id AS request_id, event_id // 700 AS batch_id,
  CASE WHEN event_id % 61 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
  regexp_extract(props,'([0-9]+)',1) AS ad_id,
  CASE event_id % 5 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' WHEN 2 THEN 'tablet' WHEN 3 THEN 'watch' ELSE NULL END AS device,
  CASE event_id % 7 WHEN 0 THEN 'header' WHEN 1 THEN 'sidebar' WHEN 2 THEN 'footer' WHEN 3 THEN 'in_content' WHEN 4 THEN 'popup' ELSE 'wall' END AS placement,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE ts END AS timestamp,
  CAST(CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 26 END AS INT) AS hour,
  CAST(CASE WHEN event_id % 3 <> 1 THEN NULL ELSE event_id % 8 END AS INT) AS day_of_week
FROM events""",
    "ab_tests": """SELECT concat('t', s_suppkey) AS test_id, 'logistic' AS model_a,
  CASE s_nationkey % 3 WHEN 0 THEN 'lightgbm' ELSE 'xgboost' END AS model_b,
  s_acctbal/9000.0::DOUBLE AS traffic_split,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s_suppkey % 20 AS INT)) AS start_time,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00' + to_hours((s_suppkey % 20) * 24 + (s_suppkey * 7) % 500 + 1) END AS end_time,
  s_suppkey % 5 <> 0 AS enabled, s_name AS description
FROM supplier""",
    "ab_log": "SELECT *, concat('t', user_id % 10) AS test_id FROM predictions",
    "ab_requests": "SELECT request_id, concat('t', user_id) AS test_id, user_id, latency_ms, error, timestamp FROM predictions",
    "baseline_rows": "SELECT * FROM predictions WHERE timestamp < TIMESTAMP '2024-01-11 00:00:00'",
    "line_labels": """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS impression_id,
  l_partkey AS user_id, l_suppkey AS ad_id, l_linestatus AS device, l_shipdate AS timestamp, l_quantity AS quantity,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS clicked
FROM lineitem""",
}

_NEEDS = {
    "scored": ["predictions"], "ab_log": ["predictions"], "ab_requests": ["predictions"],
    "baseline_rows": ["predictions"],
}


def with_tables(names: str, select: str) -> str:
    """`select` preceded by the definitions of the named tables and what they are built from.

    A select that brings its own WITH list continues the list.
    """
    wanted: list[str] = []
    for name in names.split():
        for n in [*_NEEDS.get(name, []), name]:
            if n not in wanted:
                wanted.append(n)
    head = ",\n".join(f"{n} AS ({CTE[n]})" for n in wanted)
    body = select.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}" if head else body
    return f"WITH {head}\n{body}" if head else body
