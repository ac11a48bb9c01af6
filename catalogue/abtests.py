"""A/B tests."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

import fixtures as fx
from adlens.functions import stats
from adlens.operators import abtest
from catalogue import Catalogue, rounded
from catalogue.tables import AB_METRICS

catalogue = Catalogue()
case = catalogue.case


@case("ab_assign", f"""SELECT r.request_id, r.test_id,
  CASE WHEN t.model_a IS NULL THEN NULL WHEN t.enabled AND NOT coalesce(r.timestamp > t.end_time, false) AND
    {fx.sql_md5_mod("r.test_id || ':' || r.user_id", 10000)} / 10000.0::DOUBLE < t.traffic_split THEN 'B' ELSE 'A' END AS variant,
  CASE WHEN t.model_a IS NULL THEN NULL WHEN t.enabled AND NOT coalesce(r.timestamp > t.end_time, false) AND
    {fx.sql_md5_mod("r.test_id || ':' || r.user_id", 10000)} / 10000.0::DOUBLE < t.traffic_split THEN t.model_b ELSE t.model_a END AS model_name
FROM ab_requests r LEFT JOIN ab_tests t USING (test_id)""", "ab_tests ab_requests")  # fmt: skip
def _(spark, sf):
    out = abtest.ab_assign(fx.ab_requests(spark, sf), fx.ab_tests(spark, sf))
    return out.select("request_id", "test_id", "variant", "model_name")


@case(
    "ab_status",
    f"""SELECT test_id, end_time, coalesce(TIMESTAMP '{fx.NOW}' > end_time, false) AS expired,
  enabled AND NOT coalesce(TIMESTAMP '{fx.NOW}' > end_time, false) AS active FROM ab_tests""",
    "ab_tests",
)
def _(spark, sf):
    return abtest.ab_status(fx.ab_tests(spark, sf), fx.NOW)


@case("ab_metrics", AB_METRICS, "ab_log")
def _(spark, sf):
    return rounded(abtest.ab_metrics(fx.ab_log(spark, sf)))


@case("ab_list", "SELECT * FROM ab_tests", "ab_tests")
def _(spark, sf):
    return abtest.ab_list(fx.ab_tests(spark, sf))


@case(
    "ab_validate",
    """SELECT test_id, CASE WHEN traffic_split IS NULL OR traffic_split NOT BETWEEN 0 AND 1 THEN 'traffic_split out of range'
  WHEN count(*) OVER (PARTITION BY test_id) > 1 THEN 'test_id already exists'
  WHEN model_a NOT IN (SELECT model_name FROM predictions) THEN 'unknown model_a'
  WHEN model_b NOT IN (SELECT model_name FROM predictions) THEN 'unknown model_b' END AS reject_reason
FROM (SELECT * FROM ab_tests UNION ALL SELECT * FROM ab_tests WHERE test_id LIKE '%3')""",
    "ab_tests predictions",
)
def _(spark, sf):
    tests = fx.ab_tests(spark, sf)
    twice = tests.unionByName(tests.filter(F.col("test_id").endswith("3")))
    return abtest.ab_validate(twice, fx.predictions(spark, sf)).select("test_id", "reject_reason")


# Tests whose second model is in the log, so that both sides have rows.
_PAIRED = """WITH m AS (SELECT test_id, model_name, count(*) AS n, count(*) FILTER (NOT error) AS ok, count(*) FILTER (error) AS bad,
  coalesce(avg(latency_ms) FILTER (NOT error), 0) AS mean, min(latency_ms) FILTER (NOT error) AS low, max(latency_ms) FILTER (NOT error) AS high,
  quantile_cont(latency_ms, 0.95) FILTER (NOT error) AS p95 FROM ab_log GROUP BY ALL),
p AS (SELECT t.test_id, t.model_a, t.model_b, t.traffic_split AS split, a.n AS na, b.n AS nb, a.ok AS oka, b.ok AS okb, a.bad AS bada, b.bad AS badb,
  a.mean AS ma, b.mean AS mb, a.low AS la, b.low AS lb, a.high AS ha, b.high AS hb, a.p95 AS pa, b.p95 AS pb
  FROM ab_tests t JOIN m a ON a.test_id = t.test_id AND a.model_name = t.model_a JOIN m b ON b.test_id = t.test_id AND b.model_name = t.model_b)"""


def _paired(spark, sf):
    return abtest.ab_pairing(fx.ab_tests(spark, sf), abtest.ab_metrics(fx.ab_log(spark, sf)))


@case(
    "ab_pairing",
    f"""{_PAIRED} SELECT test_id, model_a, model_b, na AS a_total_requests, nb AS b_total_requests,
  round(ma, 6) AS a_avg_prediction_time_ms, round(mb, 6) AS b_avg_prediction_time_ms FROM p""",
    "ab_tests ab_log",
)
def _(spark, sf):
    columns = ["test_id", "model_a", "model_b"] + [f"{s}_{c}" for c in ("total_requests", "avg_prediction_time_ms") for s in "ab"]
    return rounded(_paired(spark, sf).select(*columns))


@case(
    "ab_compare",
    f"""{_PAIRED} SELECT test_id, round((1 - split) * 100, 1) AS split_a_pct, round(split * 100, 1) AS split_b_pct, na AS requests_a, nb AS requests_b,
  na + nb AS requests_total, round(ma, 2) AS avg_latency_a, round(mb, 2) AS avg_latency_b, round(mb - ma, 2) AS difference_ms,
  round(CASE WHEN ma > 0 THEN (ma - mb) / ma * 100 ELSE 0 END, 2) AS improvement_pct,
  round(bada * 100 / na, 2) AS error_rate_a, round(badb * 100 / nb, 2) AS error_rate_b FROM p""",
    "ab_tests ab_log",
)
def _(spark, sf):
    return abtest.ab_compare(_paired(spark, sf))


_REPORT = [
    ("Total Requests", "na", "nb", "NULL"),
    ("Total Predictions", "oka", "okb", "NULL"),
    ("Avg Latency (ms)", "ma", "mb", "CASE WHEN ma > 0 THEN (ma - mb) / ma * 100 ELSE 0 END"),
    ("P95 Latency (ms)", "pa", "pb", "NULL"),
    ("Min Latency (ms)", "la", "lb", "NULL"),
    ("Max Latency (ms)", "ha", "hb", "NULL"),
    ("Error Count", "bada", "badb", "NULL"),
    ("Error Rate (%)", "bada * 100 / na", "badb * 100 / nb", "bada * 100 / na - badb * 100 / nb"),
    ("Success Rate (%)", "100 - bada * 100 / na", "100 - badb * 100 / nb", "NULL"),
]


@case(
    "ab_report",
    f"{_PAIRED} "
    + " UNION ALL ".join(
        f"SELECT test_id, '{m}' AS metric, round(CAST({a} AS DOUBLE), 4) AS model_a, round(CAST({b} AS DOUBLE), 4) AS model_b, round(CAST({i} AS DOUBLE), 4) AS improvement FROM p"
        for m, a, b, i in _REPORT
    ),
    "ab_tests ab_log",
)
def _(spark, sf):
    return rounded(abtest.ab_report(fx.ab_tests(spark, sf), fx.ab_log(spark, sf)), 4)


@case(
    "ab_traffic",
    f"""{_PAIRED} SELECT test_id, model_a AS model_name, round((1 - split) * 100, 6) AS configured_pct, round(na * 100 / (na + nb), 6) AS observed_pct FROM p
UNION ALL SELECT test_id, model_b, round(split * 100, 6), round(nb * 100 / (na + nb), 6) FROM p""",
    "ab_tests ab_log",
)
def _(spark, sf):
    return rounded(abtest.ab_traffic(_paired(spark, sf)))


# --- statistical tests ------------------------------------------------------------------------

_SAMPLES = """WITH s AS (SELECT l.test_id, CASE WHEN l.model_name = t.model_a THEN 'A' WHEN l.model_name = t.model_b THEN 'B' END AS variant, l.latency_ms AS v
  FROM ab_log l JOIN ab_tests t USING (test_id) WHERE NOT l.error AND l.model_name IN (t.model_a, t.model_b)),
g AS (SELECT test_id, count(v) FILTER (variant = 'A') AS na, avg(v) FILTER (variant = 'A') AS ma, var_samp(v) FILTER (variant = 'A') AS va,
  count(v) FILTER (variant = 'B') AS nb, avg(v) FILTER (variant = 'B') AS mb, var_samp(v) FILTER (variant = 'B') AS vb FROM s GROUP BY test_id),
pooled AS (SELECT *, ((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) AS pv FROM g)"""


def _samples(spark, sf):
    return abtest.ab_samples(fx.ab_tests(spark, sf), fx.ab_log(spark, sf))


def _moments(spark, sf):
    return abtest.ab_moments(_samples(spark, sf))


@case(
    "ab_ttest",
    f"{_SAMPLES} SELECT test_id, round((ma - mb) / sqrt(pv * (1 / na + 1 / nb)), 6) AS t_stat, CAST(na + nb - 2 AS DOUBLE) AS df FROM pooled WHERE na > 0 AND nb > 0",
    "ab_tests ab_log",
)
def _(spark, sf):
    return rounded(abtest.ab_ttest(_moments(spark, sf)).select("test_id", "t_stat", "df"))


def _tail(value, density, steps=2000):
    """Two-sided tail of a symmetric density, by Simpson's rule from 0 to the value (beyond 40 nothing is left)."""
    x = f"(least(abs({value}), 40) * k / {steps})"
    weight = f"CASE WHEN k IN (0, {steps}) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
    return f"round(abs(1 - 2 * (SELECT sum({weight} * {density.format(x=x)}) * least(abs({value}), 40) / {steps} / 3 FROM range({steps + 1}) r(k))), 5)"


_NORMAL_DENSITY = "exp(-{x} * {x} / 2) / sqrt(2 * pi())"
_T_DENSITY = "exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) * power(1 + {x} * {x} / df, -(df + 1) / 2)"


@case(
    "ab_ttest_p",
    f"""{_SAMPLES}, t AS (SELECT test_id, (ma - mb) / sqrt(pv * (1 / na + 1 / nb)) AS t, CAST(na + nb - 2 AS DOUBLE) AS df FROM pooled WHERE na > 0 AND nb > 0)
SELECT test_id, round(t, 6) AS t_stat, df, {_tail("t", _T_DENSITY)} AS p_value FROM t""",
    "ab_tests ab_log",
)
def _(spark, sf):
    out = abtest.ab_ttest(_moments(spark, sf))
    return rounded(out.withColumn("p_value", F.round("p_value", 5)))


@case(
    "ab_chi2",
    f"""{_PAIRED}, x AS (SELECT test_id, (na + nb) * power(greatest(abs(bada * (nb - badb) - badb * (na - bada)) - (na + nb) / 2, 0), 2)
  / ((bada + badb) * (na + nb - bada - badb) * CAST(na AS DOUBLE) * nb) AS chi2 FROM p)
SELECT test_id, round(chi2, 6) AS chi2, {_tail("sqrt(chi2)", _NORMAL_DENSITY)} AS p_value FROM x""",
    "ab_tests ab_log",
)
def _(spark, sf):
    return rounded(abtest.ab_chi2(_paired(spark, sf)).withColumn("p_value", F.round("p_value", 5)))


@case(
    "ab_mannwhitney",
    f"""{_SAMPLES}, t AS (SELECT test_id, v, count(*) FILTER (variant = 'A') AS a, count(*) FILTER (variant = 'B') AS b FROM s GROUP BY ALL),
c AS (SELECT *, coalesce(sum(b) OVER (PARTITION BY test_id ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM t),
u AS (SELECT test_id, CAST(sum(a * (below + b / 2)) AS DOUBLE) AS u, CAST(sum(a) AS DOUBLE) AS na, CAST(sum(b) AS DOUBLE) AS nb,
  CAST(sum(power(a + b, 3) - (a + b)) AS DOUBLE) AS ties FROM c GROUP BY test_id HAVING sum(a) > 0 AND sum(b) > 0),
z AS (SELECT test_id, u, greatest(greatest(u, na * nb - u) - na * nb / 2 - 0.5, 0)
  / sqrt(na * nb / 12 * (na + nb + 1 - ties / ((na + nb) * (na + nb - 1)))) AS z FROM u)
SELECT test_id, u AS u_stat, round(z, 6) AS z, {_tail("z", _NORMAL_DENSITY)} AS p_value FROM z""",
    "ab_tests ab_log",
)
def _(spark, sf):
    out = abtest.ab_mannwhitney(_samples(spark, sf))
    return out.select("test_id", "u_stat", F.round("z", 6).alias("z"), F.round("p_value", 5).alias("p_value"))


@case(
    "ab_effect",
    f"""{_SAMPLES} SELECT test_id, round((ma - mb) / sqrt(pv), 6) AS cohens_d, CASE WHEN abs((ma - mb) / sqrt(pv)) < 0.2 THEN 'small'
  WHEN abs((ma - mb) / sqrt(pv)) < 0.5 THEN 'medium' WHEN pv IS NOT NULL AND ma - mb IS NOT NULL THEN 'large' END AS effect FROM pooled""",
    "ab_tests ab_log",
)
def _(spark, sf):
    return rounded(abtest.ab_effect(_moments(spark, sf)))


@case(
    "ab_ci",
    f"""{_SAMPLES} SELECT test_id, round(ma - mb, 6) AS difference, round(ma - mb - 1.96 * sqrt(va / na + vb / nb), 6) AS ci_lower,
  round(ma - mb + 1.96 * sqrt(va / na + vb / nb), 6) AS ci_upper FROM pooled WHERE na > 1 AND nb > 1""",
    "ab_tests ab_log",
)
def _(spark, sf):
    return rounded(abtest.ab_confidence_interval(_moments(spark, sf), critical=1.96))


_Z = NormalDist().inv_cdf(1 - 0.05 / 3 / 2) + NormalDist().inv_cdf(0.8)


@case(
    "ab_sample_size",
    f"""{_SAMPLES} SELECT test_id, na AS n_a, nb AS n_b, round({2 * _Z * _Z!r}::DOUBLE * pv / power(ma * 0.05, 2), 4) AS needed,
  least(na, nb) >= {2 * _Z * _Z!r}::DOUBLE * pv / power(ma * 0.05, 2) AS enough FROM pooled""",
    "ab_tests ab_log",
)
def _(spark, sf):
    return rounded(abtest.ab_sample_size(_moments(spark, sf), comparisons=3), 4)


@case(
    "ab_normality",
    f"""{_SAMPLES}, c AS (SELECT test_id, variant, v, avg(v) OVER (PARTITION BY test_id, variant) AS m FROM s),
k AS (SELECT test_id, variant, count(*) AS n, avg(power(v - m, 2)) AS m2, avg(power(v - m, 3)) AS m3, avg(power(v - m, 4)) AS m4 FROM c GROUP BY ALL)
SELECT test_id, variant, n, round(n / 6 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4), 4) AS jarque_bera,
  round(exp(-(n / 6 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4)) / 2), 4) AS p_value FROM k""",
    "ab_tests ab_log",
)
def _(spark, sf):
    return rounded(abtest.ab_normality(_samples(spark, sf)), 4)


# Acklam's rational approximation to normal quantiles (relative error below 1.2e-9), highest power first.
_CENTRE = (
    (-3.969683028665376e1, 2.209460984245205e2, -2.759285104469687e2, 1.383577518672690e2, -3.066479806614716e1, 2.506628277459239),
    (-5.447609879822406e1, 1.615858368580409e2, -1.556989798598866e2, 6.680131188771972e1, -1.328068155288572e1, 1.0),
)
_TAIL = (
    (-7.784894002430293e-3, -3.223964580411365e-1, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783),
    (7.784695709041462e-3, 3.224671290700398e-1, 2.445134137142996, 3.754408661907416, 1.0),
)


def _horner(coefficients, x):
    out = f"({coefficients[0]!r}::DOUBLE)"
    for c in coefficients[1:]:
        out = f"({out} * {x} + ({c!r}::DOUBLE))"
    return out


def _quantile(p):
    tail = "sqrt(-2 * ln({p}))"
    one = lambda q: f"{_horner(_TAIL[0], q)} / {_horner(_TAIL[1], q)}"
    return f"""CASE WHEN {p} < 0.02425 THEN {one(tail.format(p=p))} WHEN {p} > 0.97575 THEN -({one(tail.format(p=f"(1 - {p})"))})
      ELSE ({p} - 0.5) * {_horner(_CENTRE[0], f"(({p} - 0.5) * ({p} - 0.5))")} / {_horner(_CENTRE[1], f"(({p} - 0.5) * ({p} - 0.5))")} END"""


def _power(coefficients, x):
    return " + ".join(f"({c!r}::DOUBLE) * power({x}, {k})" for k, c in enumerate(coefficients))


@case(
    "ab_shapiro",
    f"""{_SAMPLES}, o AS (SELECT test_id, variant, v, row_number() OVER (PARTITION BY test_id, variant ORDER BY v) AS i, count(*) OVER (PARTITION BY test_id, variant) AS n FROM s),
m AS (SELECT *, {_quantile("((i - 0.375) / (n + 0.25))")} AS m FROM o),
t AS (SELECT test_id, variant, any_value(n) AS n, sum(m * m) AS total, max(m) AS last, max(CASE WHEN i = n - 1 THEN m END) AS next, var_pop(v) * any_value(n) AS squares FROM m GROUP BY ALL),
a AS (SELECT *, last / sqrt(total) + {_power(stats.LAST_WEIGHT, "(1 / sqrt(n))")} AS an, next / sqrt(total) + {_power(stats.NEXT_WEIGHT, "(1 / sqrt(n))")} AS bn FROM t WHERE n > 11),
f AS (SELECT *, sqrt((total - 2 * last * last - 2 * next * next) / (1 - 2 * an * an - 2 * bn * bn)) AS f FROM a),
w AS (SELECT test_id, variant, any_value(n) AS n, power(sum(v * CASE WHEN i = n THEN an WHEN i = 1 THEN -an WHEN i = n - 1 THEN bn WHEN i = 2 THEN -bn ELSE m / f END), 2) / any_value(squares) AS w
  FROM m JOIN (SELECT * EXCLUDE n FROM f) USING (test_id, variant) GROUP BY ALL)
SELECT test_id, variant, n, round(w, 5) AS w FROM w""",
    "ab_tests ab_log",
)
def _(spark, sf):
    out = abtest.ab_shapiro(_samples(spark, sf))
    return out.filter("n > 11").select("test_id", "variant", "n", F.round("w", 5).alias("w"))


@case(
    "ab_levene",
    f"""{_SAMPLES}, z AS (SELECT test_id, variant, abs(v - median(v) OVER (PARTITION BY test_id, variant)) AS z FROM s),
k AS (SELECT test_id, variant, count(*) AS n, avg(z) AS m, var_pop(z) AS w FROM z GROUP BY ALL),
f AS (SELECT test_id, count(*) AS groups, sum(n) AS total, sum(n * m * m) - sum(n * m) * sum(n * m) / sum(n) AS between_groups, sum(n * w) AS within_groups FROM k GROUP BY test_id)
SELECT test_id, round(between_groups * (total - groups) / within_groups, 4) AS f_stat, CAST(total - groups AS DOUBLE) AS df FROM f WHERE groups = 2""",
    "ab_tests ab_log",
)
def _(spark, sf):
    return rounded(abtest.ab_levene(_samples(spark, sf)).select("test_id", "f_stat", "df"), 4)
