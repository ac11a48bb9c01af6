"""Row features: ordered history, samples and splits, encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

import fixtures as fx
from adlens.operators import encoders, history, sampling
from catalogue import Catalogue, rounded

catalogue = Catalogue()
case = catalogue.case


def _prior(expression: str, key: str) -> str:
    return f"{expression} OVER (PARTITION BY {key} ORDER BY timestamp, impression_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _history_sql(table: str, keys: dict[str, str]) -> str:
    columns = ", ".join(
        f"round(coalesce({_prior('avg(clicked)', k)}, (SELECT avg(clicked) FROM {table})), 6) AS ctr_{k}{s}" for k, s in keys.items()
    )
    return f"SELECT impression_id, {columns} FROM {table}"


_KEYS = {"user_id": "_user", "ad_id": "_ad", "device": "_device"}


@case("hist_ctr", _history_sql("impressions", _KEYS), "impressions")
def _(spark, sf):
    narrow = fx.impressions(spark, sf).select("impression_id", "timestamp", "clicked", *_KEYS)
    out = history.histories(narrow, _KEYS)
    return rounded(out.select("impression_id", *[f"ctr_{k}{s}" for k, s in _KEYS.items()]))


@case("hist_ctr_lines", _history_sql("line_labels", {"user_id": "_user", "device": "_device"}), "line_labels")
def _(spark, sf):
    narrow = fx.line_labels(spark, sf).select("impression_id", "timestamp", "clicked", "user_id", "device")
    out = history.histories(narrow, {"user_id": "_user", "device": "_device"})
    return rounded(out.select("impression_id", "ctr_user_id_user", "ctr_device_device"))


@case(
    "prior_count",
    f"SELECT impression_id, {_prior('count(*)', 'user_id')} AS impressions_user_id_user FROM impressions",
    "impressions",
)
def _(spark, sf):
    out = history.history_features(fx.impressions(spark, sf), "user_id", "_user")
    return out.select("impression_id", "impressions_user_id_user")


_LAG = "lag(epoch_us(timestamp)) OVER (PARTITION BY {key} ORDER BY timestamp, impression_id)"


@case(
    "time_since_impression",
    f"SELECT impression_id, round(coalesce((epoch_us(timestamp) - {_LAG.format(key='user_id')}) / 1e6, 0), 6) AS time_since_last_impression FROM impressions",
    "impressions",
)
def _(spark, sf):
    out = history.user_timeline(fx.impressions(spark, sf))
    return rounded(out.select("impression_id", "time_since_last_impression"))


@case(
    "click_gap",
    f"""SELECT impression_id, round(CASE WHEN clicked = 1 THEN coalesce((epoch_us(timestamp) - {_LAG.format(key='user_id, clicked')}) / 1e6, 0)
  ELSE 31536000 END, 6) AS time_since_last_click FROM impressions""",
    "impressions",
)
def _(spark, sf):
    out = history.user_timeline(fx.impressions(spark, sf))
    return rounded(out.select("impression_id", "time_since_last_click"))


@case(
    "time_since_click_safe",
    f"""SELECT impression_id, round(coalesce((epoch_us(timestamp) - {_prior('max(CASE WHEN clicked = 1 THEN epoch_us(timestamp) END)', 'user_id')}) / 1e6,
  31536000), 6) AS time_since_click_safe FROM impressions""",
    "impressions",
)
def _(spark, sf):
    out = history.user_timeline(fx.impressions(spark, sf))
    return rounded(out.select("impression_id", "time_since_click_safe"))


@case(
    "group_ctr",
    "SELECT impression_id, "
    + ", ".join(f"round(avg(clicked) OVER (PARTITION BY {', '.join(c)}), 6) AS {n}" for n, c in history.GROUP_RATES.items())
    + " FROM impressions",
    "impressions",
)
def _(spark, sf):
    out = history.group_rates(fx.impressions(spark, sf))
    return rounded(out.select("impression_id", *history.GROUP_RATES))


# --- samples and splits -----------------------------------------------------------------------

_RANK = "row_number() OVER (PARTITION BY {by} ORDER BY md5('42:' || impression_id), impression_id)"
_SIZE = "count(*) OVER (PARTITION BY clicked)"


@case(
    "stratified_sample",
    f"SELECT impression_id, clicked FROM (SELECT *, {_RANK.format(by='clicked')} AS r, {_SIZE} AS n FROM impressions) WHERE r <= floor(n * 0.3 + 0.5)",
    "impressions",
)
def _(spark, sf):
    return sampling.stratified_sample(fx.impressions(spark, sf), 0.3).select("impression_id", "clicked")


@case(
    "random_sample",
    "SELECT * FROM impressions WHERE ('0x' || substr(md5('42:' || impression_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < 0.1",
    "impressions",
)
def _(spark, sf):
    return sampling.random_sample(fx.impressions(spark, sf), 0.1, row_id="impression_id")


@case(
    "sample_n",
    f"SELECT impression_id FROM (SELECT *, {_RANK.format(by='1')} AS r FROM impressions) WHERE r <= 500",
    "impressions",
)
def _(spark, sf):
    return sampling.sample_n(fx.impressions(spark, sf), 500).select("impression_id")


@case(
    "split_train_val_test",
    f"""SELECT impression_id, CASE WHEN r <= floor(n * (0.8::DOUBLE * 0.8) + 0.5) THEN 'train' WHEN r <= floor(n * (0.8::DOUBLE * 0.8 + 0.8::DOUBLE * 0.2) + 0.5) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, {_RANK.format(by='clicked')} AS r, {_SIZE} AS n FROM impressions)""",
    "impressions",
)
def _(spark, sf):
    return sampling.split_train_val_test(fx.impressions(spark, sf)).select("impression_id", "split")


_FOLD = fx.sql_hash_bucket("'42:' || impression_id", 5)


@case("kfold_assign", f"SELECT impression_id, {_FOLD} AS fold FROM impressions", "impressions")
def _(spark, sf):
    return encoders.kfold_assign(fx.impressions(spark, sf)).select("impression_id", "fold")


# --- encodings --------------------------------------------------------------------------------


@case(
    "freq_encode",
    "SELECT impression_id, count(*) OVER (PARTITION BY user_id) AS user_id_freq FROM line_labels",
    "line_labels",
)
def _(spark, sf):
    return encoders.frequency_encode(fx.line_labels(spark, sf), "user_id").select("impression_id", "user_id_freq")


@case(
    "freq_norm",
    """WITH f AS (SELECT impression_id, count(*) OVER (PARTITION BY user_id) AS n FROM line_labels)
SELECT impression_id, round(n / (SELECT max(n) FROM f), 6) AS user_id_freq_norm FROM f""",
    "line_labels",
)
def _(spark, sf):
    out = encoders.frequency_encode(fx.line_labels(spark, sf), "user_id")
    return rounded(out.select("impression_id", "user_id_freq_norm"))


def _oof_sql(table: str, key: str) -> str:
    return f"""WITH folded AS (SELECT *, {_FOLD} AS fold FROM {table}),
per AS (SELECT {key}, fold, count(*) AS n, sum(clicked) AS s FROM folded GROUP BY ALL),
whole AS (SELECT {key}, sum(n) AS n, sum(s) AS s FROM per GROUP BY ALL)
SELECT impression_id, round(coalesce((w.s - p.s) / nullif(w.n - p.n, 0), (SELECT avg(clicked) FROM {table})), 6) AS {key}_target_enc
FROM folded f JOIN per p USING ({key}, fold) JOIN whole w USING ({key})"""


@case("target_encode_oof", _oof_sql("impressions", "user_id"), "impressions")
def _(spark, sf):
    out = encoders.target_encode_oof(fx.impressions(spark, sf), "user_id")
    return rounded(out.select("impression_id", "user_id_target_enc"))


@case("target_encode_lines", _oof_sql("line_labels", "user_id"), "line_labels")
def _(spark, sf):
    out = encoders.target_encode_oof(fx.line_labels(spark, sf), "user_id")
    return rounded(out.select("impression_id", "user_id_target_enc"))


_CUT = "TIMESTAMP '1996-01-01'"


@case(
    "target_encode_apply",
    f"""WITH old AS (SELECT * FROM line_labels WHERE timestamp < {_CUT}), means AS (SELECT user_id, avg(clicked) AS m FROM old GROUP BY user_id)
SELECT impression_id, round(coalesce(m, (SELECT avg(clicked) FROM old)), 6) AS user_id_target_enc
FROM line_labels LEFT JOIN means USING (user_id) WHERE timestamp >= {_CUT}""",
    "line_labels",
)
def _(spark, sf):
    df = fx.line_labels(spark, sf)
    before = F.col("timestamp") < F.lit("1996-01-01").cast("timestamp_ntz")
    state = encoders.fit_key(df.filter(before), "user_id")
    out = encoders.target_encode_apply(df.filter(~before), state)
    return rounded(out.select("impression_id", "user_id_target_enc"))


@case(
    "hash_features",
    "SELECT impression_id, "
    + ", ".join(f"CASE WHEN b = {i} THEN 1 ELSE 0 END AS user_id_hash_{i}" for i in range(10))
    + f" FROM (SELECT impression_id, {fx.sql_md5_mod('CAST(user_id AS VARCHAR)', 10)} AS b FROM line_labels)",
    "line_labels",
)
def _(spark, sf):
    out = encoders.hash_features(fx.line_labels(spark, sf), "user_id")
    return out.select("impression_id", *[f"user_id_hash_{i}" for i in range(10)])


@case(
    "detect_high_card",
    """SELECT c.name AS "column", c.n AS distinct_count, c.n > 1000 AS hashed FROM (
  SELECT 'user_id' AS name, count(DISTINCT user_id) AS n FROM line_labels UNION ALL
  SELECT 'ad_id', count(DISTINCT ad_id) FROM line_labels UNION ALL
  SELECT 'device', count(DISTINCT device) FROM line_labels) c WHERE c.n > 100""",
    "line_labels",
)
def _(spark, sf):
    df = fx.line_labels(spark, sf)
    columns = ["user_id", "ad_id", "device"]
    found = encoders.detect_high_cardinality(df.select(*columns, "clicked"))
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in found] or [F.lit(0).alias("none")])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct_count"), (F.lit(n) > encoders.HASH_CARDINALITY).alias("hashed")) for c, n in found.items()]
    )
    if not found:
        return spark.createDataFrame([], "column string, distinct_count bigint, hashed boolean")
    return exact.select(F.inline(rows))


@case(
    "encode_all",
    f"""WITH folded AS (SELECT *, {_FOLD} AS fold FROM line_labels),
u AS (SELECT user_id, count(*) AS n, sum(clicked) AS s FROM folded GROUP BY ALL),
uf AS (SELECT user_id, fold, count(*) AS n, sum(clicked) AS s FROM folded GROUP BY ALL),
a AS (SELECT ad_id, count(*) AS n, sum(clicked) AS s FROM folded GROUP BY ALL),
af AS (SELECT ad_id, fold, count(*) AS n, sum(clicked) AS s FROM folded GROUP BY ALL)
SELECT impression_id, u.n AS user_id_freq, round(u.n / (SELECT max(n) FROM u), 6) AS user_id_freq_norm,
  round(coalesce((u.s - uf.s) / nullif(u.n - uf.n, 0), (SELECT avg(clicked) FROM folded)), 6) AS user_id_target_enc,
  {", ".join(f"CASE WHEN {fx.sql_md5_mod('CAST(user_id AS VARCHAR)', 10)} = {i} THEN 1 ELSE 0 END AS user_id_hash_{i}" for i in range(10))},
  a.n AS ad_id_freq, round(a.n / (SELECT max(n) FROM a), 6) AS ad_id_freq_norm,
  round(coalesce((a.s - af.s) / nullif(a.n - af.n, 0), (SELECT avg(clicked) FROM folded)), 6) AS ad_id_target_enc
FROM folded JOIN u USING (user_id) JOIN uf USING (user_id, fold) JOIN a USING (ad_id) JOIN af USING (ad_id, fold)""",
    "line_labels",
)
def _(spark, sf):
    out, _states = encoders.encode_all(fx.line_labels(spark, sf), ["user_id", "ad_id"], ["user_id"])
    return rounded(
        out.select(
            "impression_id", "user_id_freq", "user_id_freq_norm", "user_id_target_enc", *[f"user_id_hash_{i}" for i in range(10)],
            "ad_id_freq", "ad_id_freq_norm", "ad_id_target_enc",
        )
    )


