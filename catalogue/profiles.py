"""Aggregations, profiling reports and the joins that put statistics on rows."""

from __future__ import annotations

from pyspark.sql import functions as F

import fixtures as fx
from adlens.operators import history, monitor, normalize, profile, requests
from adlens.schemas import PLACEMENTS
from catalogue import Catalogue, rounded

catalogue = Catalogue()
case = catalogue.case


@case("overall_ctr", "SELECT round(avg(clicked), 6) AS ctr FROM impressions", "impressions")
def _(spark, sf):
    return rounded(profile.overall_ctr(fx.impressions(spark, sf)))


@case(
    "class_balance",
    """SELECT clicked, count(*) AS count, round(count(*) * 100 / sum(count(*)) OVER (), 6) AS percentage,
  round((SELECT avg(clicked) FROM impressions), 6) AS ctr FROM impressions GROUP BY clicked""",
    "impressions",
)
def _(spark, sf):
    return rounded(profile.class_balance(fx.impressions(spark, sf)))


def _ctr_case(name, *keys):
    columns = ", ".join(keys)
    sql = f"SELECT {columns}, round(avg(clicked), 6) AS ctr, count(*) AS impressions FROM impressions GROUP BY {columns}"

    @case(name, sql, "impressions")
    def _(spark, sf):
        return rounded(profile.sorted_report(profile.ctr_by(fx.impressions(spark, sf), *keys), "ctr"))


_ctr_case("ctr_by_hour", "hour")
_ctr_case("ctr_by_device", "device")
_ctr_case("ctr_by_placement", "placement")
_ctr_case("ctr_device_placement", "device", "placement")


@case(
    "ctr_by_dow",
    """SELECT day_of_week, round(avg(clicked), 6) AS ctr, count(*) AS impressions,
  ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][day_of_week + 1] AS day_name
FROM impressions GROUP BY day_of_week""",
    "impressions",
)
def _(spark, sf):
    return rounded(profile.ctr_by_day_of_week(fx.impressions(spark, sf)))


@case(
    "ctr_pivot",
    "SELECT device, " + ", ".join(f"round(avg(clicked) FILTER (placement = '{p}'), 6) AS {p}" for p in PLACEMENTS)
    + " FROM impressions GROUP BY device",
    "impressions",
)
def _(spark, sf):
    return rounded(profile.ctr_pivot(fx.impressions(spark, sf), values=PLACEMENTS))


@case(
    "value_counts",
    "SELECT placement, count(*) AS count, round(count(*) * 100 / sum(count(*)) OVER (), 6) AS percentage FROM impressions GROUP BY placement",
    "impressions",
)
def _(spark, sf):
    return rounded(profile.value_counts(fx.impressions(spark, sf), "placement"))


def _describe_sql(columns: str, table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM {table}"""
        for c in columns.split()
    )


@case("describe_numeric", _describe_sql("user_id ad_id hour day_of_week", "impressions"), "impressions")
def _(spark, sf):
    return rounded(profile.describe_numeric(fx.impressions(spark, sf), ["user_id", "ad_id", "hour", "day_of_week"]))


@case(
    "describe_line_items",
    _describe_sql("l_quantity l_extendedprice l_discount l_tax", "lineitem"),
)
def _(spark, sf):
    lines = fx.table(spark, sf, "lineitem")
    return rounded(profile.describe_numeric(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@case(
    "table_info",
    """SELECT count(*) AS rows, CAST(11 AS INT) AS columns, min(timestamp) AS start, max(timestamp) AS "end",
  CAST(floor(epoch(date_trunc('second', max(timestamp) - min(timestamp))) / 86400) AS BIGINT) AS span_days FROM impressions""",
    "impressions",
)
def _(spark, sf):
    return profile.table_info(fx.impressions(spark, sf))


@case(
    "entity_stats",
    """SELECT 'user_id' AS entity, count(DISTINCT user_id) AS distinct_count, round(count(*) / count(DISTINCT user_id), 6) AS avg_impressions FROM impressions
UNION ALL SELECT 'ad_id', count(DISTINCT ad_id), round(count(*) / count(DISTINCT ad_id), 6) FROM impressions""",
    "impressions",
)
def _(spark, sf):
    return rounded(profile.entity_stats(fx.impressions(spark, sf)))


@case(
    "top_entities",
    "SELECT user_id, count(*) AS impressions FROM impressions GROUP BY user_id ORDER BY impressions DESC, user_id LIMIT 10",
    "impressions",
)
def _(spark, sf):
    return profile.top_entities(fx.impressions(spark, sf), "user_id")


@case(
    "activity_level",
    """SELECT impression_id, count(*) OVER (PARTITION BY user_id) AS user_activity_level,
  count(*) OVER (PARTITION BY ad_id) AS ad_impression_count FROM impressions""",
    "impressions",
)
def _(spark, sf):
    df = profile.activity_level(fx.impressions(spark, sf), "user_id", "user_activity_level")
    df = profile.activity_level(df, "ad_id", "ad_impression_count")
    return df.select("impression_id", "user_activity_level", "ad_impression_count")


@case(
    "pair_count",
    "SELECT impression_id, count(*) OVER (PARTITION BY user_id, ad_id) AS user_ad_interaction_count FROM impressions",
    "impressions",
)
def _(spark, sf):
    return profile.pair_count(fx.impressions(spark, sf)).select("impression_id", "user_ad_interaction_count")


_USER_STATS = """SELECT user_id, round(avg(clicked), 6) AS user_ctr_mean, round(stddev_samp(clicked), 6) AS user_ctr_std,
  CAST(sum(clicked) AS BIGINT) AS user_clicks_total FROM impressions GROUP BY user_id"""


@case("user_target_stats", _USER_STATS, "impressions")
def _(spark, sf):
    return rounded(profile.user_target_stats(fx.impressions(spark, sf)))


@case(
    "user_stats_merge",
    f"SELECT i.impression_id, s.* EXCLUDE (user_id) FROM impressions i LEFT JOIN ({_USER_STATS}) s USING (user_id)",
    "impressions",
)
def _(spark, sf):
    df = fx.impressions(spark, sf)
    joined = profile.join_stats(df, profile.user_target_stats(df), ["user_id"])
    return rounded(joined.select("impression_id", "user_ctr_mean", "user_ctr_std", "user_clicks_total"))


@case(
    "click_ratio",
    """SELECT impression_id, round(sum(clicked) OVER (PARTITION BY user_id) / (sum(clicked) OVER (PARTITION BY ad_id) + 1), 6)
  AS user_ad_click_ratio FROM impressions""",
    "impressions",
)
def _(spark, sf):
    return rounded(profile.click_ratio(fx.impressions(spark, sf)).select("impression_id", "user_ad_click_ratio"))


@case(
    "freq_vs_ctr",
    "SELECT user_id, count(*) AS freq, round(avg(clicked), 6) AS ctr FROM impressions GROUP BY user_id ORDER BY freq DESC, user_id LIMIT 10",
    "impressions",
)
def _(spark, sf):
    return rounded(profile.freq_vs_ctr(fx.impressions(spark, sf)))


@case(
    "trend_line",
    """SELECT round(regr_slope(clicked, freq), 6) AS slope, round(regr_intercept(clicked, freq), 6) AS intercept
FROM (SELECT clicked, count(*) OVER (PARTITION BY user_id) AS freq FROM impressions)""",
    "impressions",
)
def _(spark, sf):
    return rounded(profile.trend_line(fx.impressions(spark, sf)))


@case(
    "value_histogram",
    """SELECT label, CAST(least(floor((score - 0.0) * 20 / 0.6), 19) AS INT) AS bin, count(*) AS count
FROM scored WHERE score BETWEEN 0 AND 0.6 GROUP BY ALL""",
    "scored",
)
def _(spark, sf):
    return profile.value_histogram(fx.scored(spark, sf), "score", 20, 0.0, 0.6, ["label"])


@case(
    "nonfinite_report",
    """WITH v AS (SELECT latency_ms AS latency, CASE WHEN error THEN 'NaN'::DOUBLE ELSE predicted_ctr END AS prediction,
  CASE WHEN actual_ctr = 0 THEN 'Infinity'::DOUBLE END AS inverse FROM predictions)
SELECT 'latency' AS "column", count(*) FILTER (isnan(latency)) AS nan_count, count(*) FILTER (isinf(latency)) AS inf_count FROM v
UNION ALL SELECT 'prediction', count(*) FILTER (isnan(prediction)), count(*) FILTER (isinf(prediction)) FROM v
UNION ALL SELECT 'inverse', count(*) FILTER (isnan(inverse)), count(*) FILTER (isinf(inverse)) FROM v""",
    "predictions",
)
def _(spark, sf):
    df = fx.predictions(spark, sf).select(
        F.col("latency_ms").alias("latency"),
        F.when(F.col("error"), F.lit(float("nan"))).otherwise(F.col("predicted_ctr")).alias("prediction"),
        F.when(F.col("actual_ctr") == 0, F.lit(float("inf"))).alias("inverse"),
    )
    return profile.nonfinite_report(df)


_SHOWN = """SELECT p.*, i.device, i.placement FROM predictions p JOIN impressions i ON i.impression_id = p.request_id"""


def _shown(spark, sf):
    seen = fx.impressions(spark, sf).select(F.col("impression_id").alias("request_id"), "device", "placement")
    return fx.predictions(spark, sf).join(seen, "request_id")


@case(
    "device_rollup",
    f"""SELECT device, round(avg(predicted_ctr), 6) AS avg_predicted_ctr, round(avg(actual_ctr), 6) AS avg_actual_ctr, count(*) AS prediction_count
FROM ({_SHOWN}) WHERE timestamp >= TIMESTAMP '{fx.NOW}' - INTERVAL 7 DAY GROUP BY device""",
    "impressions predictions",
)
def _(spark, sf):
    return rounded(profile.device_rollup(normalize.filter_recent(_shown(spark, sf), fx.NOW, days=7)))


@case(
    "model_mae",
    """SELECT model_name, round(avg(predicted_ctr), 6) AS avg_prediction, round(avg(abs(predicted_ctr - actual_ctr)), 6) AS mae,
  count(*) AS total_predictions FROM predictions WHERE actual_ctr IS NOT NULL GROUP BY model_name""",
    "predictions",
)
def _(spark, sf):
    return rounded(profile.model_mae(fx.predictions(spark, sf)))


@case(
    "hourly_series",
    f"""SELECT date_trunc('hour', timestamp) AS hour, round(avg(predicted_ctr), 6) AS avg_ctr, count(*) AS request_count
FROM predictions WHERE timestamp >= TIMESTAMP '{fx.NOW}' - INTERVAL 24 HOUR GROUP BY 1""",
    "predictions",
)
def _(spark, sf):
    return rounded(profile.hourly_series(normalize.filter_recent(fx.predictions(spark, sf), fx.NOW, hours=24)))


@case("prediction_count", "SELECT count(*) AS prediction_count FROM predictions", "predictions")
def _(spark, sf):
    return profile.prediction_count(fx.predictions(spark, sf))


@case(
    "class_weight",
    "SELECT round(count(*) FILTER (clicked = 0) / count(*) FILTER (clicked = 1), 6) AS scale_pos_weight FROM impressions",
    "impressions",
)
def _(spark, sf):
    return rounded(profile.class_weight(fx.impressions(spark, sf)))


# Three models' scores per request, derived from the logged one.
_THREE = """SELECT request_id, 'xgboost' AS model_name, predicted_ctr FROM predictions
UNION ALL SELECT request_id, 'logistic', predicted_ctr * 0.5 + 0.02 FROM predictions
UNION ALL SELECT request_id, 'lightgbm', predicted_ctr * 0.9 + 0.001 FROM predictions WHERE NOT error"""


def _three(spark, sf):
    made = fx.predictions(spark, sf)
    p = F.col("predicted_ctr")
    row = lambda name, score: F.struct(F.lit(name).alias("model_name"), score.alias("predicted_ctr"))
    scores = F.array(
        row("xgboost", p), row("logistic", p * 0.5 + 0.02), F.when(~F.col("error"), row("lightgbm", p * 0.9 + 0.001))
    )
    return made.select("request_id", F.inline(F.array_compact(scores)))


@case(
    "compare_predictions",
    f"""WITH three AS ({_THREE}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY predicted_ctr DESC, model_name) AS r,
  row_number() OVER (PARTITION BY request_id ORDER BY predicted_ctr, model_name DESC) AS w FROM three),
pair AS (SELECT request_id, max(model_name) FILTER (r = 1) AS best_model, max(predicted_ctr) FILTER (r = 1) AS best_ctr,
  max(model_name) FILTER (w = 1) AS worst_model, max(predicted_ctr) FILTER (w = 1) AS worst_ctr FROM ranked GROUP BY request_id)
SELECT request_id, best_model, round(best_ctr, 6) AS best_ctr, worst_model, round(worst_ctr, 6) AS worst_ctr,
  round(best_ctr - worst_ctr, 6) AS difference, round((best_ctr - worst_ctr) / best_ctr * 100, 6) AS relative_pct,
  CASE WHEN best_ctr - worst_ctr > 0.01 THEN 'significant' ELSE 'moderate' END AS variation,
  CASE WHEN best_ctr > 0.02 THEN 'optimistic' ELSE 'conservative' END AS tone FROM pair""",
    "predictions",
)
def _(spark, sf):
    return rounded(requests.compare_predictions(_three(spark, sf)))


@case(
    "sort_report",
    "SELECT user_id, timestamp, impression_id FROM impressions ORDER BY user_id, timestamp, impression_id",
    "impressions",
)
def _(spark, sf):
    df = fx.impressions(spark, sf).select("user_id", "timestamp", "impression_id")
    return profile.sorted_report(df, "user_id", "timestamp", "impression_id", descending=False)


@case(
    "latest_n",
    "SELECT request_id, timestamp, model_name, predicted_ctr FROM predictions ORDER BY timestamp DESC, request_id DESC LIMIT 10",
    "predictions",
)
def _(spark, sf):
    df = fx.predictions(spark, sf).select("request_id", "timestamp", "model_name", "predicted_ctr")
    return profile.latest_n(df)


# --- joins ------------------------------------------------------------------------------------


@case(
    "group_stat_join",
    """SELECT impression_id, round(avg(clicked) OVER (PARTITION BY user_id), 6) AS user_ctr_overall,
  round(avg(clicked) OVER (PARTITION BY placement), 6) AS placement_ctr_overall FROM impressions""",
    "impressions",
)
def _(spark, sf):
    df = fx.impressions(spark, sf)
    out = history.group_means(df, {"user_ctr_overall": ["user_id"], "placement_ctr_overall": ["placement"]})
    return rounded(out.select("impression_id", "user_ctr_overall", "placement_ctr_overall"))


@case(
    "click_gap_merge",
    """WITH clicks AS (SELECT user_id, timestamp, coalesce((epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER
  (PARTITION BY user_id ORDER BY timestamp, impression_id)) / 1e6, 0) AS gap FROM impressions WHERE clicked = 1)
SELECT i.impression_id, round(coalesce(c.gap, 31536000), 6) AS time_since_last_click FROM impressions i
LEFT JOIN clicks c ON c.user_id = i.user_id AND c.timestamp = i.timestamp""",
    "impressions",
)
def _(spark, sf):
    out = history.click_gap_merge(fx.impressions(spark, sf))
    return rounded(out.select("impression_id", "time_since_last_click"))


@case(
    "pair_stat_join",
    """SELECT impression_id, round(avg(clicked) OVER (PARTITION BY user_id, device), 6) AS user_device_ctr,
  round(avg(clicked) OVER (PARTITION BY hour, placement), 6) AS hour_placement_ctr FROM impressions""",
    "impressions",
)
def _(spark, sf):
    groups = {n: history.GROUP_RATES[n] for n in ("user_device_ctr", "hour_placement_ctr")}
    out = history.group_means(fx.impressions(spark, sf), groups, fill_global=tuple(groups))
    return rounded(out.select("impression_id", *groups))


def _old_new(spark, sf):
    df = fx.line_labels(spark, sf)
    cut = F.col("timestamp") < F.lit("1996-01-01").cast("timestamp_ntz")
    return df.filter(cut), df.filter(~cut)


_LINES = "TIMESTAMP '1996-01-01'"


@case(
    "lookup_apply",
    f"""WITH stored AS (SELECT user_id, count(*) AS n FROM line_labels WHERE timestamp < {_LINES} GROUP BY user_id)
SELECT l.impression_id, coalesce(s.n, 0) AS user_id_freq FROM line_labels l LEFT JOIN stored s USING (user_id) WHERE l.timestamp >= {_LINES}""",
    "line_labels",
)
def _(spark, sf):
    old, new = _old_new(spark, sf)
    stored = old.groupBy("user_id").agg(F.count(F.lit(1)).alias("user_id_freq"))
    out = history.apply_lookup(new, stored, ["user_id"], "user_id_freq", F.lit(0))
    return out.select("impression_id", "user_id_freq")


@case(
    "unseen_keys",
    f"""SELECT DISTINCT user_id, ad_id FROM line_labels WHERE timestamp >= {_LINES} AND (user_id, ad_id) NOT IN
  (SELECT (user_id, ad_id) FROM line_labels WHERE timestamp < {_LINES})""",
    "line_labels",
)
def _(spark, sf):
    old, new = _old_new(spark, sf)
    return history.unseen_keys(new, old.select("user_id", "ad_id"), ["user_id", "ad_id"])


@case(
    "global_mean_cross",
    "SELECT impression_id, round((SELECT avg(clicked) FROM impressions), 6) AS global_ctr FROM impressions",
    "impressions",
)
def _(spark, sf):
    df = fx.impressions(spark, sf)
    out = history.with_global_mean(df, history.global_mean(df))
    return rounded(out.select("impression_id", F.col("_global_mean").alias("global_ctr")))


@case(
    "feedback_join",
    """SELECT p.request_id, p.model_name, p.predicted_ctr, f.actual_ctr FROM predictions p
LEFT JOIN (SELECT request_id, actual_ctr FROM predictions WHERE actual_ctr IS NOT NULL) f USING (request_id)""",
    "predictions",
)
def _(spark, sf):
    made = fx.predictions(spark, sf)
    out = monitor.attach_feedback(made, profile.with_feedback(made))
    return out.select("request_id", "model_name", "predicted_ctr", "actual_ctr")
