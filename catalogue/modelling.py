"""Feature selection, feature table, models and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

import fixtures as fx
from adlens.operators import evaluate, leafwise, models, selection
from adlens.operators.normalize import cyclical_time
from adlens.operators.ordered import running
from adlens.plans import feature_table, scoring, training
from adlens.sources.materialise import materialise
from catalogue import Catalogue, rounded, scratch

catalogue = Catalogue()
case = catalogue.case

# Numeric columns for selection: one nearly constant, two that repeat each other, one with gaps.
_NUMBERS = """SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_quantity * 2 + l_tax AS doubled,
  CASE WHEN l_discount > 0.05 THEN NULL ELSE l_quantity END AS partial, l_tax * 0 + 1 AS constant,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS clicked FROM lineitem"""
_NAMES = "l_quantity l_extendedprice l_discount l_tax doubled partial constant".split()


def _numbers(spark, sf):
    return fx.table(spark, sf, "lineitem").selectExpr(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_quantity * 2 + l_tax AS doubled",
        "CASE WHEN l_discount > 0.05 THEN NULL ELSE l_quantity END AS partial", "l_tax * 0 + 1 AS constant",
        "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS clicked",
    )


def _variance_sql() -> str:
    return f"WITH n AS ({_NUMBERS}) " + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(var_pop(coalesce({c}, (SELECT greatest(abs(max({c})) * 2, 1e6) FROM n))) / 1e6, 3) AS variance_millions,
  var_pop(coalesce({c}, (SELECT greatest(abs(max({c})) * 2, 1e6) FROM n))) > 0.01 AS keep FROM n"""
        for c in _NAMES
    )


@case("low_variance", _variance_sql())
def _(spark, sf):
    report = selection.variance_report(_numbers(spark, sf))
    return report.select("feature", F.round(F.col("variance") / 1e6, 3).alias("variance_millions"), "keep")


def _pair_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(_NAMES) for b in _NAMES[i + 1 :]]
    return f"WITH n AS ({_NUMBERS}), c AS (" + " UNION ALL ".join(
        f"""SELECT '{a}' AS feature_1, '{b}' AS feature_2,
  CASE WHEN stddev_pop({a}) FILTER ({b} IS NOT NULL) > 0 AND stddev_pop({b}) FILTER ({a} IS NOT NULL) > 0 THEN abs(corr({a}, {b})) END AS correlation FROM n"""
        for a, b in pairs
    ) + ") "


@case("high_corr", _pair_sql() + "SELECT feature_2 AS feature, round(max(correlation), 6) AS max_correlation FROM c GROUP BY 1 HAVING max(correlation) > 0.95")
def _(spark, sf):
    return rounded(selection.high_correlation_report(_numbers(spark, sf)))


@case("corr_pairs", _pair_sql() + "SELECT feature_1, feature_2, round(correlation, 6) AS correlation FROM c WHERE correlation > 0.9")
def _(spark, sf):
    return rounded(selection.correlated_pairs(_numbers(spark, sf), 0.9, _NAMES))


@case("importance_topn")
def _(spark, sf):
    df = cyclical_time(fx.impressions(spark, sf))
    columns = ["hour", "day_of_week", "ad_id", "hour_sin", "hour_cos"]
    ranked = selection.importance_ranking(df, columns)
    return spark.createDataFrame(ranked[:3], "feature string, importance double")


_DROPPED = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CASE WHEN (SELECT var_pop({c}) FROM n) <= 0.01 THEN 'low variance' WHEN EXISTS (SELECT 1 FROM c JOIN v USING (feature_1)
  WHERE feature_2 = '{c}' AND correlation > 0.95) THEN 'correlated' ELSE 'kept' END AS outcome"""
    for c in _NAMES
)


# The variance of `partial`, whose gaps are filled with large values, never falls below the limit.
@case(
    "select_features",
    _pair_sql().rstrip()
    + ", v AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature_1 FROM n HAVING var_pop({c}) > 0.01" for c in _NAMES)
    + f") SELECT feature, outcome FROM ({_DROPPED}) UNION ALL SELECT 'clicked', 'kept'",
)
def _(spark, sf):
    df = _numbers(spark, sf)
    chosen = selection.select_features(df)
    rows = [(c, "kept") for c in chosen.kept] + list(chosen.dropped.items())
    return spark.createDataFrame(rows, "feature string, outcome string")


_OPTIONS = feature_table.FeatureOptions(apply_selection=False, hashed_columns=())
_FEATURES = [
    "hour", "day_of_week", "is_weekend", "is_business_hours", "ctr_user_id_user", "impressions_user_id_user",
    "user_activity_level", "time_since_last_impression", "time_since_click_safe", "ctr_ad_id_ad",
    "ctr_device_device", "user_id_freq", "user_id_target_enc", "ad_id_target_enc",
]


def _prior(expression: str, key: str) -> str:
    return f"{expression} OVER (PARTITION BY {key} ORDER BY timestamp, impression_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


_FOLD = fx.sql_hash_bucket("'42:' || impression_id", 5)
_MEAN = "(SELECT avg(clicked) FROM impressions)"


def _encoded(key: str) -> str:
    n, s = f"count(*) OVER (PARTITION BY {key})", f"sum(clicked) OVER (PARTITION BY {key})"
    nf, sf = f"count(*) OVER (PARTITION BY {key}, fold)", f"sum(clicked) OVER (PARTITION BY {key}, fold)"
    return f"round(coalesce(({s} - {sf}) / nullif({n} - {nf}, 0), {_MEAN}), 6) AS {key}_target_enc"


@case(
    "feature_table",
    f"""SELECT impression_id, hour, day_of_week, is_weekend, CASE WHEN hour BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours,
  round(coalesce({_prior('avg(clicked)', 'user_id')}, {_MEAN}), 6) AS ctr_user_id_user,
  {_prior('count(*)', 'user_id')} AS impressions_user_id_user, count(*) OVER (PARTITION BY user_id) AS user_activity_level,
  round(coalesce((epoch_us(timestamp) - {_prior('max(epoch_us(timestamp))', 'user_id')}) / 1e6, 0), 6) AS time_since_last_impression,
  round(coalesce((epoch_us(timestamp) - {_prior('max(CASE WHEN clicked = 1 THEN epoch_us(timestamp) END)', 'user_id')}) / 1e6, 31536000), 6) AS time_since_click_safe,
  round(coalesce({_prior('avg(clicked)', 'ad_id')}, {_MEAN}), 6) AS ctr_ad_id_ad,
  round(coalesce({_prior('avg(clicked)', 'device')}, {_MEAN}), 6) AS ctr_device_device,
  count(*) OVER (PARTITION BY user_id) AS user_id_freq, {_encoded('user_id')}, {_encoded('ad_id')}
FROM (SELECT *, {_FOLD} AS fold FROM impressions)""",
    "impressions",
)
def _(spark, sf):
    out, _state = feature_table.fit_transform(fx.impressions(spark, sf), _OPTIONS)
    return rounded(out.select("impression_id", *_FEATURES))


def _share_of_top(key):
    return f"count(*) OVER (PARTITION BY {key}) / (SELECT max(n) FROM (SELECT count(*) AS n FROM impressions GROUP BY {key}))"


#: Every numeric feature, in the order of the table.
_BUILT = {
    "user_id": "user_id", "ad_id": "ad_id", "hour": "hour", "day_of_week": "day_of_week", "is_weekend": "is_weekend",
    "ctr_user_id_user": f"coalesce({_prior('avg(clicked)', 'user_id')}, {_MEAN})",
    "impressions_user_id_user": _prior("count(*)", "user_id"),
    "user_activity_level": "count(*) OVER (PARTITION BY user_id)",
    "time_since_last_impression": f"coalesce((epoch_us(timestamp) - {_prior('max(epoch_us(timestamp))', 'user_id')}) / 1e6, 0)",
    "time_since_click_safe": f"coalesce((epoch_us(timestamp) - {_prior('max(CASE WHEN clicked = 1 THEN epoch_us(timestamp) END)', 'user_id')}) / 1e6, 31536000)",
    "user_id_freq": "count(*) OVER (PARTITION BY user_id)",
    "user_id_freq_norm": _share_of_top("user_id"),
    "user_id_target_enc": _encoded("user_id").rsplit(" AS ", 1)[0],
    "ctr_ad_id_ad": f"coalesce({_prior('avg(clicked)', 'ad_id')}, {_MEAN})",
    "impressions_ad_id_ad": _prior("count(*)", "ad_id"),
    "ad_impression_count": "count(*) OVER (PARTITION BY ad_id)",
    "ad_id_freq": "count(*) OVER (PARTITION BY ad_id)",
    "ad_id_freq_norm": _share_of_top("ad_id"),
    "ad_id_target_enc": _encoded("ad_id").rsplit(" AS ", 1)[0],
    "ctr_device_device": f"coalesce({_prior('avg(clicked)', 'device')}, {_MEAN})",
    "impressions_device_device": _prior("count(*)", "device"),
    "month": "month(timestamp)", "day": "day(timestamp)", "week_of_year": "week(timestamp)",
    "is_business_hours": "CASE WHEN hour BETWEEN 9 AND 17 THEN 1 ELSE 0 END",
    **{f"user_id_hash_{i}": f"CASE WHEN {fx.sql_md5_mod('CAST(user_id AS VARCHAR)', 10)} = {i} THEN 1 ELSE 0 END" for i in range(10)},
}
_ORDER = list(_BUILT)
_VARIANCES = ", ".join(f"{{'i': {i}, 'feature': '{c}', 'v': var_pop({c})::DOUBLE, 'mean': avg({c})::DOUBLE}}" for i, c in enumerate(_ORDER))
_RELATED = ", ".join(
    f"{{'i': {i}, 'j': {j}, 'r': abs(corr({_ORDER[i]}, {_ORDER[j]}))::DOUBLE}}" for j in range(len(_ORDER)) for i in range(j)
)


@case(
    "feature_table_selected",
    f"""WITH f AS MATERIALIZED (SELECT clicked, {", ".join(f"{e} AS {c}" for c, e in _BUILT.items())} FROM (SELECT *, {_FOLD} AS fold FROM impressions)),
v AS (SELECT unnest(x, recursive := true) FROM (SELECT unnest([{_VARIANCES}]) AS x FROM f)),
r AS (SELECT unnest(x, recursive := true) FROM (SELECT unnest([{_RELATED}]) AS x FROM f)),
varying AS (SELECT i FROM v WHERE v > 0.01),
related AS (SELECT DISTINCT j FROM r WHERE i IN (SELECT i FROM varying) AND j IN (SELECT i FROM varying) AND r > 0.95),
o AS (SELECT feature, mean, CASE WHEN i NOT IN (SELECT i FROM varying) THEN 'low variance' WHEN i IN (SELECT j FROM related) THEN 'correlated' ELSE 'kept' END AS outcome FROM v)
SELECT feature, outcome, CASE WHEN outcome = 'kept' THEN round(mean, 4) END AS mean FROM o""",
    "impressions",
)
def _(spark, sf):
    """The whole build - history, encodings, hashing and selection - as what became of each feature."""
    options = feature_table.FeatureOptions(hashed_columns=("user_id",))
    out, state = feature_table.fit_transform(fx.impressions(spark, sf), options)
    kept = [c for c in out.columns if c in _BUILT]
    means = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit("kept").alias("outcome"), F.round(F.avg(c), 4).alias("mean")) for c in kept])
    dropped = spark.createDataFrame([(c, why, None) for c, why in state.dropped.items()], "feature string, outcome string, mean double")
    return out.agg(means.alias("rows")).select(F.inline("rows")).unionByName(dropped)


@case(
    "feature_table_compat",
    f"""SELECT impression_id, round(avg(clicked) OVER (PARTITION BY user_id), 6) AS user_ctr_overall,
  round(avg(clicked) OVER (PARTITION BY ad_id), 6) AS ad_ctr_overall, round(avg(clicked) OVER (PARTITION BY device), 6) AS device_ctr_overall,
  round(avg(clicked) OVER (PARTITION BY placement), 6) AS placement_ctr_overall,
  round(avg(clicked) OVER (PARTITION BY device, placement), 6) AS device_placement_ctr,
  round(avg(clicked) OVER (PARTITION BY user_id, device), 6) AS user_device_ctr,
  round(avg(clicked) OVER (PARTITION BY hour, placement), 6) AS hour_placement_ctr,
  round(CASE WHEN clicked = 1 THEN coalesce((epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (PARTITION BY user_id, clicked ORDER BY timestamp, impression_id)) / 1e6, 0)
    ELSE 31536000 END, 6) AS time_since_last_click, device || '_' || placement AS device_placement FROM impressions""",
    "impressions",
)
def _(spark, sf):
    options = feature_table.FeatureOptions(compat=True, create_advanced=False, apply_selection=False)
    out, _state = feature_table.fit_transform(fx.impressions(spark, sf), options)
    return rounded(
        out.select(
            "impression_id", "user_ctr_overall", "ad_ctr_overall", "device_ctr_overall", "placement_ctr_overall",
            "device_placement_ctr", "user_device_ctr", "hour_placement_ctr", "time_since_last_click", "device_placement",
        )
    )


_CUT = "TIMESTAMP '2024-01-20'"


@case(
    "feature_state",
    f"""WITH old AS (SELECT * FROM impressions WHERE timestamp < {_CUT}), u AS (SELECT user_id, count(*) AS n, avg(clicked) AS m,
    max(epoch_us(timestamp)) AS seen, max(CASE WHEN clicked = 1 THEN epoch_us(timestamp) END) AS click FROM old GROUP BY user_id)
SELECT i.impression_id, round(coalesce(u.m, (SELECT avg(clicked) FROM old)), 6) AS ctr_user_id_user, coalesce(u.n, 0) AS impressions_user_id_user,
  round(coalesce((epoch_us(i.timestamp) - u.seen) / 1e6, 0), 6) AS time_since_last_impression,
  round(coalesce((epoch_us(i.timestamp) - u.click) / 1e6, 31536000), 6) AS time_since_click_safe,
  coalesce(u.n, 0) AS user_id_freq, round(coalesce(u.m, (SELECT avg(clicked) FROM old)), 6) AS user_id_target_enc
FROM impressions i LEFT JOIN u USING (user_id) WHERE i.timestamp >= {_CUT}""",
    "impressions",
)
def _(spark, sf):
    df = fx.impressions(spark, sf)
    before = F.col("timestamp") < F.lit("2024-01-20").cast("timestamp_ntz")
    _out, state = feature_table.fit_transform(df.filter(before), _OPTIONS)
    path = scratch(spark, "state")
    state.save(path)
    loaded = feature_table.FeatureState.load(spark, path)
    out = feature_table.transform(df.filter(~before).drop("clicked"), loaded)
    return rounded(
        out.select(
            "impression_id", "ctr_user_id_user", "impressions_user_id_user", "time_since_last_impression",
            "time_since_click_safe", "user_id_freq", "user_id_target_enc",
        )
    )


# --- models: full settings; a model that several queries need is fitted once per session and table ------------

_TRAINING = ["hour", "day_of_week", "is_weekend", "ad_id", "hour_sin", "hour_cos"]


def _training_table(spark, sf):
    return cyclical_time(fx.impressions(spark, sf)).select("impression_id", "clicked", *_TRAINING)


_FITTED: dict = {}


def _fitted(spark, sf, name):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _FITTED:
        df = _training_table(spark, sf)
        if name == "lightgbm":
            _FITTED[key] = models.train_gbt_leaf(_held_out(df), _TRAINING, validation="held", row_id="impression_id")
        else:
            _FITTED[key] = models.TRAINERS[name](df, _TRAINING)
    return _FITTED[key]


_WEIGHTED = """weighted AS (SELECT *, CASE WHEN clicked = 1 THEN (SELECT count(*) FILTER (clicked = 0) / count(*) FILTER (clicked = 1) FROM impressions) ELSE 1 END AS w FROM impressions)"""


def _loss_and_rate(spark, sf, name):
    """Rows a model scored, and its balanced log loss and mean rate over them."""
    df = _training_table(spark, sf)
    scored = models.score_batch(df, {name: _fitted(spark, sf, name)}, _TRAINING, name)
    ratio = df.agg((F.count_if(F.col("clicked") == 0) / F.count_if(F.col("clicked") == 1)).alias("ratio"))
    weight = F.when(F.col("clicked") == 1, F.col("ratio")).otherwise(1.0)
    hit = F.when(F.col("clicked") == 1, F.col("predicted_ctr")).otherwise(1 - F.col("predicted_ctr"))
    # Size bound: one row.
    return scored.crossJoin(F.broadcast(ratio)).groupBy("model_name").agg(
        F.count("predicted_ctr").alias("rows"),
        F.sum("clicked").alias("clicks"),
        (F.sum(weight * F.col("predicted_ctr")) / F.sum(weight)).alias("rate"),
        (F.sum(-weight * F.log(hit)) / F.sum(weight)).alias("loss"),
    )


def _held_out(df):
    """A fifth of the rows, to stop boosting by."""
    return df.withColumn("held", F.pmod(F.xxhash64("impression_id"), F.lit(5)) == 0)


# An unpenalised intercept makes the weighted rates add up to the weighted clicks: half of all weight.
@case(
    "train_logistic",
    f"""WITH {_WEIGHTED} SELECT 'logistic' AS model_name, count(*) AS rows, sum(clicked)::BIGINT AS clicks,
  round(sum(w * clicked) / sum(w), 3) AS rate, true AS beats_chance FROM weighted""",
    "impressions",
)
def _(spark, sf):
    out = _loss_and_rate(spark, sf, "logistic")
    return out.select("model_name", "rows", "clicks", F.round("rate", 3).alias("rate"), (F.col("loss") < F.log(F.lit(2.0))).alias("beats_chance"))


_SCALED_GRADIENT = " UNION ALL ".join(f"SELECT '{f}' AS feature, 0.0::DOUBLE AS gradient" for f in _TRAINING)


@case("logistic_gradient", _SCALED_GRADIENT)
def _(spark, sf):
    """The gradient of the penalised loss is zero at the fit, by each standardised feature."""
    df = _training_table(spark, sf)
    fitted = _fitted(spark, sf, "logistic")
    scaler, model = fitted.stages
    ratio = df.agg(F.count_if(F.col("clicked") == 0) / F.count_if(F.col("clicked") == 1)).first()[0]
    scored = models.score_batch(df, {"logistic": fitted}, _TRAINING, "logistic")
    weight = F.when(F.col("clicked") == 1, ratio).otherwise(1.0)
    residual = weight * (F.col("predicted_ctr") - F.col("clicked"))
    sums = []
    for i, f in enumerate(_TRAINING):
        value = (models.known_value(f) - float(scaler.mean[i])) / float(scaler.std[i] or 1.0)
        slope = F.sum(residual * value) / F.sum(weight) + 1e-6 * float(model.coefficients[i])
        sums.append(F.struct(F.lit(f).alias("feature"), (F.round(slope, 3) + 0.0).alias("gradient")).alias(f))
    return scored.agg(*sums).select(F.inline(F.array(*_TRAINING)))


def _boosted(spark, sf, name, trees):
    """Full settings: what was scored, how many trees there are, and that they beat the even rate they start from."""
    return _loss_and_rate(spark, sf, name).select(
        "model_name", "rows", "clicks", F.lit(trees).alias("trees"), (F.col("loss") < F.log(F.lit(2.0))).alias("beats_chance")
    )


_SCORED = "count(*) AS rows, sum(clicked)::BIGINT AS clicks"


@case("train_gbt", f"SELECT 'xgboost' AS model_name, {_SCORED}, CAST(100 AS INT) AS trees, true AS beats_chance FROM impressions", "impressions")
def _(spark, sf):
    return _boosted(spark, sf, "xgboost", _fitted(spark, sf, "xgboost").getNumTrees)


@case("train_gbt_leaf", f"SELECT 'lightgbm' AS model_name, {_SCORED}, true AS within_settings, true AS best_round, true AS beats_chance FROM impressions", "impressions")
def _(spark, sf):
    """Trees of at most 31 leaves and depth 6, of unequal depth, kept up to the best held-out round."""
    model = _fitted(spark, sf, "lightgbm")
    depths = [[n.depth for n in t if n.left < 0] for t in model.trees]
    within = 1 <= len(depths) <= 100 and all(len(d) <= 31 and max(d) <= 6 for d in depths)
    best = len(model.trees) == model.losses.index(min(model.losses)) + 1
    return _boosted(spark, sf, "lightgbm", len(depths)).drop("trees").select(
        "model_name", "rows", "clicks", F.lit(within).alias("within_settings"), F.lit(best).alias("best_round"), "beats_chance"
    )


# The first two splits of a tree grown by gain, over features whose every value is a bin: all cuts of the root, then
# all cuts of both its children, of which the better is made. Balanced classes: every row starts at an even rate.
_SPLIT_FEATURES = ["hour", "day_of_week"]
_CUTS = " UNION ALL ".join(
    f"""SELECT side, '{f}' AS feature, {f} AS threshold, sum(sum(g)) OVER w AS gl, sum(sum(h)) OVER w AS hl, sum(count(*)) OVER w AS nl,
  sum(sum(g)) OVER a AS g, sum(sum(h)) OVER a AS h, sum(count(*)) OVER a AS n FROM {{rows}} GROUP BY side, {f}
  WINDOW w AS (PARTITION BY side ORDER BY {f} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY side)"""
    for f in _SPLIT_FEATURES
)
_GAIN = "gl * gl / hl + (g - gl) * (g - gl) / (h - hl) - g * g / h"
_BEST = f"""SELECT side, feature, threshold, {_GAIN} AS gain, nl AS rows_left, n - nl AS rows_right FROM ({{cuts}})
  WHERE nl >= 20 AND n - nl >= 20 AND hl >= 0.001 AND h - hl >= 0.001 QUALIFY row_number() OVER (PARTITION BY side ORDER BY gain DESC) = 1"""


@case(
    "gbt_leaf_splits",
    f"""WITH r AS (SELECT 0 AS side, hour, day_of_week, 0.5 * w - clicked * w AS g, 0.25 * w AS h
  FROM (SELECT *, CASE WHEN clicked = 1 THEN (SELECT count(*) FILTER (clicked = 0) / count(*) FILTER (clicked = 1) FROM impressions) ELSE 1 END AS w FROM impressions)),
root AS ({_BEST.format(cuts=_CUTS.format(rows="r"))}),
halves AS (SELECT CASE WHEN (CASE feature WHEN 'hour' THEN hour ELSE day_of_week END) <= threshold THEN 1 ELSE 2 END AS side, hour, day_of_week, g, h
  FROM r, (SELECT feature, threshold FROM root)),
next AS (SELECT * FROM ({_BEST.format(cuts=_CUTS.format(rows="halves"))}) ORDER BY gain DESC LIMIT 1)
SELECT CAST(step AS INT) AS step, feature, CAST(threshold AS DOUBLE) AS threshold, round(gain, 6) AS gain, CAST(rows_left AS BIGINT) AS rows_left, CAST(rows_right AS BIGINT) AS rows_right
FROM (SELECT 1 AS step, * FROM root UNION ALL SELECT 2, * FROM next)""",
    "impressions",
)
def _(spark, sf):
    df = _training_table(spark, sf)
    model = models.train_gbt_leaf(
        df, _SPLIT_FEATURES, row_id="impression_id", rounds=1, leaves=3, subsample=1.0, column_sample=1.0
    )
    nodes = spark.createDataFrame(model.nodes(), leafwise.TREE_SCHEMA)
    child = nodes.select("tree", F.col("node").alias("child"), F.col("rows").alias("child_rows"))
    names = F.element_at(F.array(*[F.lit(f) for f in _SPLIT_FEATURES]), F.col("feature") + 1)
    side = lambda c: child.select("tree", F.col("child").alias(c), F.col("child_rows").cast("long").alias(f"rows_{c}"))
    splits = nodes.filter("left >= 0").join(side("left"), ["tree", "left"]).join(side("right"), ["tree", "right"])
    step = F.when(F.col("node") == 0, 1).otherwise(2).alias("step")
    return splits.select(step, names.alias("feature"), "threshold", F.round("gain", 6).alias("gain"), "rows_left", "rows_right")


@case("train_models")
def _(spark, sf):
    result = training.train_models(_training_table(spark, sf), ["logistic", "lightgbm"])
    return result.comparison()


def _with_holes(spark, sf):
    return _training_table(spark, sf).withColumn("hour_sin", F.when(F.col("hour") != 3, F.col("hour_sin")))


_REASON = "CASE WHEN hour = 3 THEN 'unusable feature value' END AS score_error"


@case(
    "score_batch",
    f"SELECT impression_id, 'logistic' AS model_name, {_REASON}, hour <> 3 AS scored FROM impressions",
    "impressions",
)
def _(spark, sf):
    scored = models.score_batch(_with_holes(spark, sf), {"logistic": _fitted(spark, sf, "logistic")}, _TRAINING, "logistic")
    usable = F.coalesce((F.col("predicted_ctr") > 0) & (F.col("predicted_ctr") < 1), F.lit(False))
    return scored.select("impression_id", "model_name", "score_error", usable.alias("scored"))


@case(
    "score_fallback",
    "SELECT CASE WHEN hour = 3 THEN 'unusable feature value' END AS score_error, count(*) AS rows, CASE WHEN hour = 3 THEN 0.02::DOUBLE END AS default_rate FROM impressions GROUP BY 1, 3",
    "impressions",
)
def _(spark, sf):
    fitted = {"logistic": _fitted(spark, sf, "logistic")}
    scored = models.score_batch(_with_holes(spark, sf), fitted, _TRAINING, "logistic", models.DEFAULT_CTR)
    given = F.when(F.col("score_error").isNotNull(), F.col("predicted_ctr"))
    return scored.groupBy("score_error").agg(F.count("predicted_ctr").alias("rows"), F.max(given).alias("default_rate"))


_BUCKET = fx.sql_md5_mod("r.test_id || ':' || r.user_id", 10000)


@case(
    "score_requests",
    f"""WITH a AS (SELECT r.request_id, r.test_id, t.model_a, t.model_b, t.enabled AND NOT coalesce(TIMESTAMP '{fx.NOW}' > t.end_time, false) AND
    {_BUCKET} / 10000.0::DOUBLE < t.traffic_split AS b FROM ab_requests r LEFT JOIN ab_tests t USING (test_id)),
m AS (SELECT *, CASE WHEN b THEN model_b ELSE model_a END AS m FROM a)
SELECT request_id, test_id, CASE WHEN m IN ('logistic', 'xgboost') THEN CASE WHEN b THEN 'B' ELSE 'A' END END AS variant,
  CASE WHEN m IN ('logistic', 'xgboost') THEN m END AS model_name, CASE WHEN m IS NULL OR m = 'lightgbm' THEN 'no such test or model' END AS reject_reason,
  coalesce(m, 'lightgbm') <> 'lightgbm' AS scored FROM m""",
    "ab_tests ab_requests",
)
def _(spark, sf):
    df = fx.impressions(spark, sf)
    features = ["hour", "day_of_week", "ctr_user_id_user", "ctr_ad_id_ad", "user_id_target_enc"]
    built, state = feature_table.fit_transform(df, _OPTIONS)
    narrow = materialise(built.select("clicked", *features), "training")
    fitted = {"logistic": models.train_logistic(narrow, features), "xgboost": models.train_gbt(narrow, features, rounds=3)}
    asked = fx.ab_requests(spark, sf).select("request_id", "test_id", "timestamp").join(
        df.select(F.col("impression_id").alias("request_id"), "user_id", "ad_id", "device", "placement"), "request_id"
    )
    incoming = asked.withColumns({c: F.lit(None).cast("int") for c in ("hour", "day_of_week")})
    scored, refused = scoring.score_requests(incoming, state, fitted, features, fx.NOW, fx.ab_tests(spark, sf))
    nothing = F.lit(None).cast("string")
    return scored.select(
        "request_id", "test_id", "variant", "model_name", nothing.alias("reject_reason"), F.col("predicted_ctr").isNotNull().alias("scored")
    ).unionByName(
        refused.select("request_id", "test_id", nothing.alias("variant"), nothing.alias("model_name"), "reject_reason", F.lit(False).alias("scored"))
    )


_RANKED = """WITH t AS (SELECT model_name, score, sum(label) AS p, count(*) - sum(label) AS q FROM scored GROUP BY ALL),
c AS (SELECT *, coalesce(sum(p) OVER w, 0) AS bp, coalesce(sum(q) OVER w, 0) AS bq, sum(p) OVER (PARTITION BY model_name) AS tp, sum(q) OVER (PARTITION BY model_name) AS tq
  FROM t WINDOW w AS (PARTITION BY model_name ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
_EPS = "2.220446049250313e-16"
_CLIPPED = f"least(greatest(score, {_EPS}::DOUBLE), 1 - {_EPS}::DOUBLE)"
_METRICS = f"""{_RANKED}, r AS (SELECT model_name, sum(p * (bq + q / 2)) / max(tp * tq) AS roc_auc, sum(p * (tp - bp) / (tp - bp + tq - bq)) / max(tp) AS pr_auc FROM c GROUP BY model_name),
l AS (SELECT model_name, avg(-CASE WHEN label = 1 THEN ln({_CLIPPED}) ELSE ln(1 - {_CLIPPED}) END) AS log_loss,
  avg(CASE WHEN (score >= 0.5) = (label = 1) THEN 1 ELSE 0 END) AS accuracy FROM scored GROUP BY model_name)"""


@case(
    "evaluate",
    f"{_METRICS} SELECT model_name, round(roc_auc, 6) AS roc_auc, round(log_loss, 6) AS log_loss, round(pr_auc, 6) AS pr_auc, round(accuracy, 6) AS accuracy FROM r JOIN l USING (model_name)",
    "scored",
)
def _(spark, sf):
    return rounded(evaluate.evaluate(fx.scored(spark, sf)))


@case(
    "model_comparison",
    f"{_METRICS} SELECT model_name, round(roc_auc, 4) AS roc_auc, round(log_loss, 4) AS log_loss, round(pr_auc, 4) AS pr_auc FROM r JOIN l USING (model_name)",
    "scored",
)
def _(spark, sf):
    return evaluate.model_comparison(evaluate.evaluate(fx.scored(spark, sf)))


@case(
    "best_model",
    f"{_METRICS} SELECT model_name, round(roc_auc, 6) AS roc_auc FROM r ORDER BY r.roc_auc DESC, model_name LIMIT 1",
    "scored",
)
def _(spark, sf):
    return rounded(evaluate.best_model(evaluate.evaluate(fx.scored(spark, sf))))


@case(
    "roc_curve",
    f"""{_RANKED} SELECT model_name, score AS threshold, round((tq - bq) / tq, 6) AS fpr, round((tp - bp) / tp, 6) AS tpr FROM c
UNION ALL SELECT DISTINCT model_name, 'Infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM scored""",
    "scored",
)
def _(spark, sf):
    return evaluate.roc_curve(fx.scored(spark, sf)).withColumns({c: F.round(c, 6) for c in ("fpr", "tpr")})


@case(
    "pr_curve",
    f"""{_RANKED} SELECT model_name, score AS threshold, round((tp - bp) / (tp - bp + tq - bq), 6) AS precision, round((tp - bp) / tp, 6) AS recall FROM c
UNION ALL SELECT DISTINCT model_name, 'Infinity'::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM scored""",
    "scored",
)
def _(spark, sf):
    return evaluate.pr_curve(fx.scored(spark, sf)).withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@case(
    "calibration_curve",
    """SELECT model_name, CAST(greatest(ceil(score * 10), 1) AS INT) AS bin, round(avg(score), 6) AS mean_predicted,
  round(avg(label), 6) AS fraction_positive, count(*) AS count FROM scored GROUP BY ALL""",
    "scored",
)
def _(spark, sf):
    return rounded(evaluate.calibration_curve(fx.scored(spark, sf)))


@case(
    "confusion_counts",
    "SELECT model_name, label AS actual, CASE WHEN score >= 0.05 THEN 1 ELSE 0 END AS predicted, count(*) AS count FROM scored GROUP BY ALL",
    "scored",
)
def _(spark, sf):
    return evaluate.confusion_counts(fx.scored(spark, sf), 0.05)


@case(
    "score_histogram",
    "SELECT model_name, label, CAST(least(floor(score * 50), 49) AS INT) AS bin, count(*) AS count FROM scored GROUP BY ALL",
    "scored",
)
def _(spark, sf):
    return evaluate.score_histogram(fx.scored(spark, sf))


@case(
    "example_rows",
    "SELECT id, label AS actual, score AS predicted_prob, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted_class FROM scored ORDER BY id LIMIT 20",
    "scored",
)
def _(spark, sf):
    return evaluate.example_rows(fx.scored(spark, sf))


@case("feature_importance", f"SELECT CAST({len(_TRAINING)} AS BIGINT) AS features, 1.0::DOUBLE AS total, true AS in_order")
def _(spark, sf):
    """Shares of the gain: of every feature, one in all, the strongest first."""
    ranked = models.feature_importance(_fitted(spark, sf, "xgboost"), _TRAINING, _training_table(spark, sf))
    rows = ranked.collect()
    shares = [r["importance"] for r in rows]
    return ranked.agg(
        F.count_distinct("feature").alias("features"), F.round(F.sum("importance"), 6).alias("total")
    ).withColumn("in_order", F.lit(shares == sorted(shares, reverse=True)))


# Both curves keep the number of clicks: what they give adds up to the labels, and never falls as the score rises.
_CALIBRATED = "SELECT count(*) AS rows, round(sum(label)::DOUBLE, 1) AS calibrated, CAST(0 AS BIGINT) AS falls FROM scored"


def _calibration(out):
    points = out.groupBy("score").agg(F.max("calibrated").alias("high"), F.min("calibrated").alias("low"), F.sum("calibrated").alias("sum"), F.count(F.lit(1)).alias("n"))
    ordered = running(points.withColumn("curve", F.lit("all")), ["curve"], ["score"], lasts={"before": F.col("high")})
    return ordered.agg(
        F.sum("n").alias("rows"), F.round(F.sum("sum"), 1).alias("calibrated"),
        F.count_if((F.col("low") < F.col("before") - 1e-12) | (F.col("high") > F.col("low") + 1e-12)).alias("falls"),
    )


@case("calibrate_platt", "SELECT count(*) AS rows, round(sum(label)::DOUBLE, 1) AS calibrated, true AS monotone FROM scored", "scored")
def _(spark, sf):
    scored = fx.scored(spark, sf)
    out = _calibration(models.apply_platt(models.fit_platt(scored), scored))
    # A curve of one slope either never falls or never rises.
    points = scored.select("score").distinct().count()
    return out.select("rows", "calibrated", F.col("falls").isin(0, points - 1).alias("monotone"))


@case("calibrate_isotonic", _CALIBRATED, "scored")
def _(spark, sf):
    scored = fx.scored(spark, sf)
    return _calibration(models.apply_isotonic(models.fit_isotonic(scored), scored))


@case(
    "compare_models",
    "SELECT impression_id, model_name, true AS scored FROM impressions, (VALUES ('logistic'), ('lightgbm')) m(model_name)",
    "impressions",
)
def _(spark, sf):
    df = _training_table(spark, sf)
    fitted = {name: _fitted(spark, sf, name) for name in ("logistic", "lightgbm")}
    scores = models.compare_models(df, fitted, _TRAINING)
    return scores.select("impression_id", "model_name", F.col("predicted_ctr").between(0, 1).alias("scored"))


@case("one_hot", "SELECT impression_id, " + ", ".join(
    f"CASE WHEN device = '{d}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS device_{d}" for d in ("desktop", "mobile", "tablet")
) + " FROM impressions", "impressions")
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    encoded = models.one_hot(fx.impressions(spark, sf), ["device"])
    values = vector_to_array("device_onehot")
    return encoded.select("impression_id", *[values[i].alias(f"device_{d}") for i, d in enumerate(("desktop", "mobile", "tablet"))])


@case("grid_search", "SELECT unnest([0.0::DOUBLE, 0.01::DOUBLE, 0.1::DOUBLE]) AS reg_param, true AS is_auc")
def _(spark, sf):
    _model, scores = models.grid_search_logistic(_training_table(spark, sf), _TRAINING)
    return spark.createDataFrame([(float(v), bool(0.4 < s <= 1)) for v, s in scores], "reg_param double, is_auc boolean")
