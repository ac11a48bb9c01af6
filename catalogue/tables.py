"""Sources, sinks, normalisation, predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

import fixtures as fx
from adlens.operators import abtest, evaluate, normalize, profile, requests
from adlens.schemas import RAW_LOG
from adlens.sources import ab_store, prediction_log, tables
from catalogue import Catalogue, rounded, scratch

catalogue = Catalogue()
case = catalogue.case

EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


@case("read_table", EVENTS)
def _(spark, sf):
    return tables.read_table(spark, f"{sf}/events.parquet")


@case("read_table_auto", EVENTS)
def _(spark, sf):
    events = fx.table(spark, sf, "events")
    path = scratch(spark, "auto")
    tables.write_features(events, path)
    return tables.read_table_auto(spark, path, events.schema)


@case("read_raw_log", "SELECT CAST(id AS VARCHAR) AS id, click, hour, C1, banner_pos, device_type, device_id, device_ip, C14 FROM raw_log", "raw_log")
def _(spark, sf):
    path = scratch(spark, "raw")
    fx.raw_log(spark, sf).write.option("header", True).option("compression", "gzip").csv(path)
    return tables.read_raw_log(spark, path, schema=RAW_LOG)


@case(
    "read_raw_log_headers",
    """SELECT CAST(id AS VARCHAR) AS id, click, hour, CASE WHEN id % 3 <> 2 THEN C1 END AS C1, CASE WHEN id % 3 = 2 THEN device_id END AS device_id,
  CASE WHEN id % 3 = 2 THEN 'x' || id END AS campaign FROM raw_log""",
    "raw_log",
)
def _(spark, sf):
    """Files of three headers in one folder: another order, and other columns."""
    path = scratch(spark, "raw")
    log = fx.raw_log(spark, sf)
    for part, columns in enumerate((["id", "click", "hour", "C1"], ["C1", "hour", "id", "click"], ["device_id", "campaign", "click", "id", "hour"])):
        rows = log.filter(F.col("id") % 3 == part).withColumn("campaign", F.concat(F.lit("x"), F.col("id").cast("string")))
        rows.select(*columns).write.mode("append").option("header", True).option("compression", "gzip").csv(path)
    return tables.read_raw_log(spark, path, schema=RAW_LOG).select("id", "click", "hour", "C1", "device_id", "campaign")


@case("read_parquet_lazy", "SELECT device, count(*) AS clicks FROM impressions WHERE clicked = 1 GROUP BY device", "impressions")
def _(spark, sf):
    return fx.impressions(spark, sf).filter("clicked = 1").groupBy("device").agg(F.count(F.lit(1)).alias("clicks"))


IMPRESSIONS = "SELECT * FROM impressions"


@case("write_table_sized", IMPRESSIONS, "impressions")
def _(spark, sf):
    df = fx.impressions(spark, sf)
    written = tables.write_table_sized(df, scratch(spark, "sized"))
    return tables.read_table(spark, written, df.schema)


@case("write_features", IMPRESSIONS, "impressions")
def _(spark, sf):
    df = fx.impressions(spark, sf)
    path = scratch(spark, "features") + ".parquet"
    tables.write_features(df, path)
    return tables.read_table(spark, path)


def _scored_requests(spark, sf):
    shown = fx.impressions(spark, sf).select(
        F.col("impression_id").alias("request_id"), "ad_id", "device", "placement", "hour", "day_of_week"
    )
    return prediction_log.combine_batch(shown, fx.predictions(spark, sf))


LOGGED = """SELECT CAST(p.user_id AS VARCHAR) AS user_id, CAST(i.ad_id AS VARCHAR) AS ad_id, i.device, i.placement,
  p.predicted_ctr, p.actual_ctr, {time} AS timestamp, p.model_name, CAST(p.request_id AS VARCHAR) AS request_id,
  i.hour, i.day_of_week
FROM predictions p JOIN impressions i ON i.impression_id = p.request_id"""


def _unpack(log):
    return log.select(
        *[c for c in log.columns if c not in ("features", "date")],
        F.get_json_object("features", "$.hour").cast("int").alias("hour"),
        F.get_json_object("features", "$.day_of_week").cast("int").alias("day_of_week"),
    )


@case("predictions_sink", LOGGED.format(time=f"TIMESTAMP '{fx.NOW}'"), "impressions predictions")
def _(spark, sf):
    path = scratch(spark, "log")
    prediction_log.append_predictions(prediction_log.prediction_rows(_scored_requests(spark, sf), fx.NOW), path)
    return _unpack(prediction_log.read_log(spark, path))


@case(
    "predictions_sink_batch",
    """SELECT count(*) AS logged, count(*) FILTER (request_id % 50 = 0) AS refused, count(actual_ctr) AS with_actual, count(*) AS read_back,
  count(DISTINCT request_id) AS requests, count(*) FILTER (request_id % 50 = 0) AS without_rate FROM predictions""",
    "predictions",
)
def _(spark, sf):
    made = fx.predictions(spark, sf)
    rate = F.when(F.col("request_id") % 50 != 0, F.col("predicted_ctr")).alias("predicted_ctr")
    scores = made.select("request_id", "model_name", rate)
    asked = made.select("request_id", "user_id", "timestamp")
    path, reports = scratch(spark, "batches"), []
    # Two batches, the second written twice, as after a failure.
    for name, part in (("even", 0), ("odd", 1), ("odd", 1)):
        mine = asked.filter(F.col("request_id") % 2 == part)
        batch = prediction_log.combine_batch(mine, scores, profile.with_feedback(made))
        reports.append(prediction_log.log_batch(prediction_log.prediction_rows(batch, fx.NOW), path, name))
    total = {k: sum(getattr(r, k) for r in reports[:2]) for k in ("logged", "refused", "with_actual")}
    written = prediction_log.read_log(spark, path)
    counts = written.groupBy("request_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("predicted_ctr").isNull()).alias("w"))
    return counts.agg(
        *[F.lit(v).cast("long").alias(k) for k, v in total.items()],
        F.sum("n").alias("read_back"), F.count(F.lit(1)).alias("requests"), F.sum("w").alias("without_rate"),
    )


@case(
    "predictions_table",
    """SELECT CAST(timestamp AS DATE) AS date, model_name, count(*) AS rows FROM predictions
WHERE CAST(timestamp AS DATE) >= DATE '2024-01-15' GROUP BY ALL""",
    "predictions",
)
def _(spark, sf):
    path = scratch(spark, "log")
    log = fx.predictions(spark, sf).withColumn("device", F.lit("mobile"))
    prediction_log.append_predictions(log, path)
    return (
        prediction_log.read_log(spark, path, "2024-01-15")
        .groupBy("date", "model_name")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@case(
    "training_table",
    "SELECT date, device, clicked = 1 AS clicked, count(*) AS rows, sum(hour) AS hours FROM impressions GROUP BY ALL",
    "impressions",
)
def _(spark, sf):
    path = scratch(spark, "training")
    prediction_log.append_training(prediction_log.training_rows(fx.impressions(spark, sf)), path)
    return (
        spark.read.parquet(path)
        .groupBy("date", "device", "clicked")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.get_json_object("features", "$.hour").cast("bigint")).alias("hours"),
        )
    )


_STORED_TIME = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _store(spark, entries, name):
    """JSON files, each a map of the entries (`test_id`, `c`) that fall to it."""
    path = scratch(spark, name)
    documents = entries.groupBy(F.pmod(F.xxhash64("test_id"), F.lit(6)).alias("part")).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("test_id", "c"))), _STORED_TIME).alias("value")
    )
    documents.write.partitionBy("part").text(path)
    return path


@case("load_ab_tests", "SELECT * FROM ab_tests", "ab_tests")
def _(spark, sf):
    tests = fx.ab_tests(spark, sf)
    path = _store(spark, tests.select("test_id", F.struct(*tests.columns).alias("c")), "tests")
    return ab_store.load_ab_tests(spark, path)


AB_METRICS = """SELECT test_id, model_name, count(*) AS total_requests, count(*) FILTER (NOT error) AS total_predictions,
  round(coalesce(avg(latency_ms) FILTER (NOT error), 0), 6) AS avg_prediction_time_ms,
  round(coalesce(sum(latency_ms) FILTER (NOT error), 0), 6) AS total_prediction_time_ms,
  coalesce(min(latency_ms) FILTER (NOT error), 'Infinity'::DOUBLE) AS min_prediction_time_ms,
  coalesce(max(latency_ms) FILTER (NOT error), 0) AS max_prediction_time_ms,
  count(*) FILTER (error) AS error_count, max(timestamp) AS last_updated
FROM ab_log GROUP BY test_id, model_name"""


@case("load_ab_metrics", AB_METRICS, "ab_log")
def _(spark, sf):
    metrics = abtest.ab_metrics(fx.ab_log(spark, sf))
    # Infinity has no JSON form: it is stored as null.
    low = F.col("min_prediction_time_ms")
    stored = metrics.withColumn("min_prediction_time_ms", F.when(low < float("inf"), low))
    models = (
        stored.select("test_id", "model_name", F.struct(*stored.columns).alias("c"))
        .groupBy("test_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("model_name", "c"))).alias("c"))
    )
    return rounded(ab_store.load_ab_metrics(spark, _store(spark, models, "metrics")))


@case("save_ab_tables", AB_METRICS, "ab_log")
def _(spark, sf):
    path = scratch(spark, "ab")
    ab_store.save_ab_table(abtest.ab_metrics(fx.ab_log(spark, sf)), path)
    return rounded(spark.read.parquet(path))


@case(
    "write_eval_results",
    """SELECT model_name, count(*) AS rows, round(avg(CASE WHEN (score >= 0.5) = (label = 1) THEN 1 ELSE 0 END), 4) AS accuracy
FROM scored GROUP BY model_name""",
    "scored",
)
def _(spark, sf):
    scored = fx.scored(spark, sf)
    sizes = scored.groupBy("model_name").agg(F.count(F.lit(1)).alias("rows"))
    report = sizes.join(evaluate.loss_metrics(scored), "model_name").select("model_name", "rows", F.round("accuracy", 4).alias("accuracy"))
    path = scratch(spark, "results") + ".csv"
    tables.write_report(report, path)
    return tables.read_table(spark, path, report.schema)


# --- normalisation ----------------------------------------------------------------------------

_PARSED = """CASE WHEN hour IS NOT NULL AND regexp_full_match(lpad_hour, '[0-9]{8}') THEN try_cast(
  (CASE WHEN lpad_hour[1:2] >= '69' THEN '19' ELSE '20' END) || lpad_hour[1:2] || '-' || lpad_hour[3:4] || '-' || lpad_hour[5:6]
  || ' ' || lpad_hour[7:8] || ':00:00' AS TIMESTAMP) END"""
_RAW_TIME = f"""WITH padded AS (SELECT *, CASE WHEN length(hour) < 8 THEN lpad(hour, 8, '0') ELSE hour END AS lpad_hour FROM raw_log),
timed AS (SELECT * EXCLUDE (hour, lpad_hour), {_PARSED} AS ts FROM padded)"""


@case("norm_target", "SELECT id, click AS clicked FROM raw_log", "raw_log")
def _(spark, sf):
    return normalize.normalise_target(fx.raw_log(spark, sf)).select("id", "clicked")


_CALENDAR = """CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) - 1 AS INT) AS day_of_week,
  coalesce(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END, 0) AS is_weekend, CAST(ts AS DATE) AS date"""


@case("norm_hour", f"{_RAW_TIME} SELECT id, ts AS timestamp, {_CALENDAR} FROM timed", "raw_log")
def _(spark, sf):
    df = normalize.normalise_hour(fx.raw_log(spark, sf))
    return df.select("id", "timestamp", "hour", "day_of_week", "is_weekend", "date")


@case("temporal_base", f"SELECT impression_id, {_CALENDAR} FROM (SELECT impression_id, timestamp AS ts FROM impressions)", "impressions")
def _(spark, sf):
    df = normalize.add_calendar(fx.impressions(spark, sf).select("impression_id", "timestamp"))
    return df.drop("timestamp")


_DEVICE = "CASE device_type WHEN 1 THEN 'desktop' WHEN 2 THEN 'mobile' WHEN 4 THEN 'tablet' ELSE 'other' END"
_PLACE = "CASE banner_pos % 5 WHEN 0 THEN 'header' WHEN 1 THEN 'sidebar' WHEN 2 THEN 'footer' WHEN 3 THEN 'in_content' WHEN 4 THEN 'popup' ELSE 'other' END"
_USER = "coalesce(device_id, 'nan') || '_' || coalesce(device_ip, 'nan')"


@case("norm_device", f"SELECT id, {_DEVICE} AS device FROM raw_log", "raw_log")
def _(spark, sf):
    return normalize.normalise_device(fx.raw_log(spark, sf)).select("id", "device")


@case("norm_placement", f"SELECT id, {_PLACE} AS placement FROM raw_log", "raw_log")
def _(spark, sf):
    return normalize.normalise_placement(fx.raw_log(spark, sf)).select("id", "placement")


@case("composite_user", f"SELECT id, {_USER} AS user_id FROM raw_log", "raw_log")
def _(spark, sf):
    return normalize.composite_user(fx.raw_log(spark, sf)).select("id", "user_id")


@case("pick_ad_id", "SELECT id, CAST(C14 AS VARCHAR) AS ad_id FROM raw_log", "raw_log")
def _(spark, sf):
    return normalize.pick_ad_id(fx.raw_log(spark, sf)).select("id", "ad_id")


@case(
    "reorder_standard",
    f"""{_RAW_TIME} SELECT {_USER} AS user_id, CAST(C14 AS VARCHAR) AS ad_id, {_DEVICE} AS device, {_PLACE} AS placement,
  ts AS timestamp, {_CALENDAR}, click AS clicked, id, C1, banner_pos, device_type, device_id, device_ip, C14 FROM timed""",
    "raw_log",
)
def _(spark, sf):
    return normalize.normalise_log(fx.raw_log(spark, sf))


_TIME_OF_DAY = "CASE WHEN hour <= 6 THEN 'night' WHEN hour <= 12 THEN 'morning' WHEN hour <= 18 THEN 'afternoon' ELSE 'evening' END"


@case(
    "temporal_features",
    f"""SELECT impression_id, CAST(month(timestamp) AS INT) AS month, CAST(day(timestamp) AS INT) AS day,
  CAST(weekofyear(timestamp) AS INT) AS week_of_year, CASE WHEN hour BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours,
  {_TIME_OF_DAY} AS time_of_day FROM impressions""",
    "impressions",
)
def _(spark, sf):
    df = normalize.temporal_features(fx.impressions(spark, sf))
    return df.select("impression_id", "month", "day", "week_of_year", "is_business_hours", "time_of_day")


@case("interaction_key", "SELECT impression_id, device || '_' || placement AS device_placement FROM impressions", "impressions")
def _(spark, sf):
    return normalize.interaction_key(fx.impressions(spark, sf)).select("impression_id", "device_placement")


@case(
    "cyclical_time",
    """SELECT impression_id, round(sin(2*pi()*hour/24), 6) + 0.0 AS hour_sin, round(cos(2*pi()*hour/24), 6) + 0.0 AS hour_cos,
  round(sin(2*pi()*day_of_week/7), 6) + 0.0 AS day_of_week_sin, round(cos(2*pi()*day_of_week/7), 6) + 0.0 AS day_of_week_cos FROM impressions""",
    "impressions",
)
def _(spark, sf):
    df = normalize.cyclical_time(fx.impressions(spark, sf))
    return rounded(df.select("impression_id", "hour_sin", "hour_cos", "day_of_week_sin", "day_of_week_cos"))


_TS = f"coalesce(timestamp, TIMESTAMP '{fx.NOW}')"


@case(
    "prepare_requests",
    f"""SELECT request_id, {_TS} AS timestamp, coalesce(hour, CAST(hour({_TS}) AS INT)) AS hour,
  coalesce(day_of_week, CAST(isodow({_TS}) - 1 AS INT)) AS day_of_week,
  CASE WHEN coalesce(day_of_week, isodow({_TS}) - 1) >= 5 THEN 1 ELSE 0 END AS is_weekend,
  CAST({_TS} AS DATE) AS date FROM requests""",
    "requests",
)
def _(spark, sf):
    df = requests.prepare_requests(fx.requests(spark, sf), fx.NOW)
    return df.select("request_id", "timestamp", "hour", "day_of_week", "is_weekend", "date")


_ORDINAL = """CASE device WHEN 'desktop' THEN 1 WHEN 'tablet' THEN 2 ELSE 0 END AS device_encoded,
  CASE placement WHEN 'sidebar' THEN 1 WHEN 'footer' THEN 2 WHEN 'in_content' THEN 3 WHEN 'popup' THEN 4 ELSE 0 END AS placement_encoded"""


@case("ordinal_encode", f"SELECT request_id, {_ORDINAL} FROM requests", "requests")
def _(spark, sf):
    return requests.ordinal_encode(fx.requests(spark, sf)).select("request_id", "device_encoded", "placement_encoded")


@case("align_features", f"SELECT request_id, {_ORDINAL}, hour, 0 AS ctr_user_id_user FROM requests", "requests")
def _(spark, sf):
    encoded = requests.ordinal_encode(fx.requests(spark, sf))
    return requests.align_features(
        encoded, ["device_encoded", "placement_encoded", "hour", "ctr_user_id_user"], ["request_id"]
    )


@case("numeric_columns", "SELECT impression_id, user_id, ad_id, hour, day_of_week, is_weekend FROM impressions", "impressions")
def _(spark, sf):
    return normalize.select_numeric(fx.impressions(spark, sf), ["clicked"])


_PCT = "CAST(CAST(floor(floor({x}*10000+0.5)/100) AS BIGINT) AS VARCHAR) || '.' || lpad(CAST(CAST(floor({x}*10000+0.5) AS BIGINT) % 100 AS VARCHAR), 2, '0') || '%'"
_BAND = "CASE WHEN predicted_ctr < 0.01 THEN 'low' WHEN predicted_ctr < 0.05 THEN 'moderate' ELSE 'high' END"


def _cases_sql(column: str, sentences: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sentences.items()) + " END"


_HOUR_KIND = "CASE WHEN hour BETWEEN 9 AND 17 THEN 'business' WHEN hour BETWEEN 18 AND 22 THEN 'evening' ELSE 'off_peak' END"


def _shown(spark, sf):
    seen = fx.impressions(spark, sf).select(F.col("impression_id").alias("request_id"), "device", "placement", "hour")
    return fx.predictions(spark, sf).join(seen, "request_id")


_SHOWN = "SELECT p.*, i.device, i.placement, i.hour FROM predictions p JOIN impressions i ON i.impression_id = p.request_id"


@case(
    "prediction_explanation",
    f"""WITH remarks AS (SELECT request_id, predicted_ctr,
  [x FOR x IN [{_cases_sql('device', requests.DEVICE_SENTENCES)}, {_cases_sql('placement', requests.PLACEMENT_SENTENCES)},
    {_cases_sql(_HOUR_KIND, requests.HOUR_SENTENCES)}, {_cases_sql(_BAND, requests.BAND_SENTENCES)}] IF x IS NOT NULL] AS r
  FROM ({_SHOWN}))
SELECT request_id, 'This ad impression has a predicted CTR of **' || {_PCT.format(x='predicted_ctr')} || '**. ' ||
  array_to_string(r[1:3], ' ') || ' The most important factor is **user_ctr** (importance: -0.420).' AS explanation FROM remarks""",
    "impressions predictions",
)
def _(spark, sf):
    df = requests.explain_prediction(_shown(spark, sf), {"hour": 0.1, "user_ctr": -0.42})
    return df.select("request_id", "explanation")


@case("ctr_band", f"SELECT {_BAND} AS band, count(*) AS n FROM predictions GROUP BY band", "predictions")
def _(spark, sf):
    band = requests.ctr_band(F.col("predicted_ctr")).alias("band")
    return fx.predictions(spark, sf).groupBy(band).agg(F.count(F.lit(1)).alias("n"))


@case(
    "validate_requests",
    """WITH sized AS (SELECT *, count(*) OVER (PARTITION BY batch_id) AS batch_size FROM requests)
SELECT request_id, CASE WHEN user_id IS NULL THEN 'missing user_id' WHEN ad_id IS NULL THEN 'missing ad_id'
  WHEN device IS NULL THEN 'missing device' WHEN placement IS NULL THEN 'missing placement'
  WHEN hour NOT BETWEEN 0 AND 23 THEN 'hour out of range' WHEN day_of_week NOT BETWEEN 0 AND 6 THEN 'day_of_week out of range'
  WHEN batch_size NOT BETWEEN 1 AND 1000 THEN 'batch size out of range' END AS reject_reason FROM sized""",
    "requests",
)
def _(spark, sf):
    return requests.validate_requests(fx.requests(spark, sf), "batch_id").select("request_id", "reject_reason")


@case(
    "quality_checks",
    """WITH t AS (SELECT user_id, ad_id, device, placement, hour, clicked FROM impressions)
SELECT count(*) AS total_rows, count(*) FILTER (clicked NOT IN (0,1)) AS bad_clicked,
  count(*) FILTER (device NOT IN ('mobile','desktop','tablet')) AS bad_device,
  count(*) FILTER (placement NOT IN ('header','sidebar','footer','in_content','popup')) AS bad_placement,
  count(*) FILTER (hour NOT BETWEEN 0 AND 23) AS bad_hour, min(user_id) AS min_user_id, max(user_id) AS max_user_id,
  min(ad_id) AS min_ad_id, max(ad_id) AS max_ad_id, min(hour) AS min_hour, max(hour) AS max_hour,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS duplicate_rows FROM t""",
    "impressions",
)
def _(spark, sf):
    df = fx.impressions(spark, sf).select("user_id", "ad_id", "device", "placement", "hour", "clicked")
    return normalize.quality_checks(df)


@case(
    "class_from_threshold",
    "SELECT id, CASE WHEN score >= 0.05 THEN 1 ELSE 0 END AS predicted_class FROM scored",
    "scored",
)
def _(spark, sf):
    return requests.classify(fx.scored(spark, sf), 0.05, "score").select("id", "predicted_class")


# --- predicates -------------------------------------------------------------------------------


@case("filter_clicked", "SELECT * FROM impressions WHERE clicked = 1", "impressions")
def _(spark, sf):
    return normalize.filter_clicked(fx.impressions(spark, sf))


@case(
    "filter_recent",
    f"SELECT request_id, timestamp FROM predictions WHERE timestamp >= TIMESTAMP '{fx.NOW}' - INTERVAL 7 DAY",
    "predictions",
)
def _(spark, sf):
    return normalize.filter_recent(fx.predictions(spark, sf), fx.NOW, days=7).select("request_id", "timestamp")


@case("filter_not_null", "SELECT request_id, actual_ctr FROM predictions WHERE actual_ctr IS NOT NULL", "predictions")
def _(spark, sf):
    return profile.with_feedback(fx.predictions(spark, sf)).select("request_id", "actual_ctr")


@case("filter_point", "SELECT * FROM predictions WHERE user_id = 7", "predictions")
def _(spark, sf):
    return prediction_log.user_predictions(fx.predictions(spark, sf), 7)


def _missing_sql(columns: str, table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
        (count(*) - count({c})) * 100 / count(*) AS missing_percentage FROM {table}"""
        for c in columns.split()
    )


_REQUEST_COLUMNS = "request_id batch_id user_id ad_id device placement timestamp hour day_of_week"


@case("filter_nonzero_missing", f"SELECT * FROM ({_missing_sql(_REQUEST_COLUMNS, 'requests')}) WHERE missing_count > 0", "requests")
def _(spark, sf):
    return profile.only_missing(profile.missing_report(fx.requests(spark, sf)))


@case("missing_report", _missing_sql(_REQUEST_COLUMNS, "requests"), "requests")
def _(spark, sf):
    return profile.missing_report(fx.requests(spark, sf))
