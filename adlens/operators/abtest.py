"""A/B tests: traffic assignment, metrics, comparison and statistical tests.

A test is a row (test_id, model_a, model_b, traffic_split, start_time, end_time, enabled,
description); a log row is (test_id, model_name, latency_ms, error, timestamp).
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.hashing import md5_mod
from adlens.functions.stats import critical_t, inner_score_sum, p_value, shapiro
from adlens.operators.ordered import exact_quantiles, value_counts_running
from adlens.sources.materialise import materialise

BUCKETS = 10_000


def end_time(start: Column, duration_hours: Column) -> Column:
    """Start plus duration; an absent or zero duration never ends."""
    return F.when(duration_hours > 0, start + F.make_dt_interval(F.lit(0), duration_hours))


def is_active(now: Column) -> Column:
    """Enabled, and not past the end time."""
    expired = F.coalesce(now > F.col("end_time"), F.lit(False))
    return F.col("enabled") & ~expired


def ab_status(tests: DataFrame, now: str) -> DataFrame:
    at = F.lit(now).cast("timestamp_ntz")
    expired = F.coalesce(at > F.col("end_time"), F.lit(False))
    return tests.select(
        "test_id",
        "end_time",
        expired.alias("expired"),
        is_active(at).alias("active"),
    )


def ab_list(tests: DataFrame) -> DataFrame:
    return tests.select(
        "test_id", "model_a", "model_b", "traffic_split", "start_time", "end_time", "enabled", "description"
    )


def ab_validate(tests: DataFrame, models: DataFrame) -> DataFrame:
    """Add `reject_reason`: split outside [0, 1], repeated id, or a model not in `models`."""
    ids = tests.groupBy("test_id").agg(F.count(F.lit(1)).alias("_copies"))
    known = models.select(F.col("model_name")).distinct()
    a = known.select(F.col("model_name").alias("model_a"), F.lit(True).alias("_a"))
    b = known.select(F.col("model_name").alias("model_b"), F.lit(True).alias("_b"))
    split = F.col("traffic_split")
    return (
        tests.join(ids, "test_id", "left")
        .join(a, "model_a", "left")
        .join(b, "model_b", "left")
        .select(
            *tests.columns,
            F.when(split.isNull() | ~split.between(0, 1), "traffic_split out of range")
            .when(F.col("_copies") > 1, "test_id already exists")
            .when(F.col("_a").isNull(), "unknown model_a")
            .when(F.col("_b").isNull(), "unknown model_b")
            .alias("reject_reason"),
        )
    )


def bucket_of(test_id: Column, user_id: Column) -> Column:
    """A user's fixed place in 0 .. 9999 for one test."""
    return md5_mod(F.concat(test_id.cast("string"), F.lit(":"), user_id.cast("string")), BUCKETS)


def ab_assign(requests: DataFrame, tests: DataFrame, now: str | None = None, at: str = "timestamp") -> DataFrame:
    """Add variant and model_name. A user always gets the same variant of a test.

    Disabled and expired tests send everybody to A. The time is `now`, or each row's own time.
    A request naming no known test gets nulls.
    """
    time = F.lit(now).cast("timestamp_ntz") if now else F.col(at)
    config = tests.select("test_id", "model_a", "model_b", "traffic_split", "end_time", "enabled")
    joined = requests.join(config, "test_id", "left")
    in_b = bucket_of(F.col("test_id"), F.col("user_id")) / F.lit(float(BUCKETS)) < F.col("traffic_split")
    variant = F.when(F.col("model_a").isNull(), None).when(is_active(time) & in_b, "B").otherwise("A")
    return joined.withColumn("variant", variant).select(
        *requests.columns,
        "variant",
        F.when(F.col("variant") == "B", F.col("model_b")).otherwise(F.col("model_a")).alias("model_name"),
    )


def ab_metrics(log: DataFrame) -> DataFrame:
    """Counters per test and model; latencies of failed requests do not count."""
    ok = F.when(~F.col("error"), F.col("latency_ms"))
    return log.groupBy("test_id", "model_name").agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(~F.col("error")).alias("total_predictions"),
        F.coalesce(F.avg(ok), F.lit(0.0)).alias("avg_prediction_time_ms"),
        F.coalesce(F.sum(ok), F.lit(0.0)).alias("total_prediction_time_ms"),
        F.coalesce(F.min(ok), F.lit(float("inf"))).alias("min_prediction_time_ms"),
        F.coalesce(F.max(ok), F.lit(0.0)).alias("max_prediction_time_ms"),
        F.count_if("error").alias("error_count"),
        F.max("timestamp").alias("last_updated"),
    )


_SIDE = [
    "total_requests", "total_predictions", "avg_prediction_time_ms", "min_prediction_time_ms",
    "max_prediction_time_ms", "error_count",
]


def ab_pairing(tests: DataFrame, metrics: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Metrics of model A beside those of model B, one row per test that has both."""
    columns = columns or _SIDE
    config = tests.select("test_id", "model_a", "model_b", "traffic_split")
    joined = metrics.join(config, "test_id")
    a, b = F.col("model_name") == F.col("model_a"), F.col("model_name") == F.col("model_b")
    return (
        joined.groupBy("test_id", "model_a", "model_b", "traffic_split")
        .agg(
            *[F.max(F.when(a, F.col(c))).alias(f"a_{c}") for c in columns],
            *[F.max(F.when(b, F.col(c))).alias(f"b_{c}") for c in columns],
        )
        .filter(F.col(f"a_{columns[0]}").isNotNull() & F.col(f"b_{columns[0]}").isNotNull())
    )


def _rate(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * 100, whole), F.lit(0.0))


def ab_compare(paired: DataFrame) -> DataFrame:
    """Traffic, latency difference, improvement of B over A and error rates, two decimals."""
    a, b = F.col("a_avg_prediction_time_ms"), F.col("b_avg_prediction_time_ms")
    improvement = F.when(a > 0, (a - b) / a * 100).otherwise(0.0)
    split = F.col("traffic_split")
    return paired.select(
        "test_id",
        F.round((1 - split) * 100, 1).alias("split_a_pct"),
        F.round(split * 100, 1).alias("split_b_pct"),
        F.col("a_total_requests").alias("requests_a"),
        F.col("b_total_requests").alias("requests_b"),
        (F.col("a_total_requests") + F.col("b_total_requests")).alias("requests_total"),
        F.round(a, 2).alias("avg_latency_a"),
        F.round(b, 2).alias("avg_latency_b"),
        F.round(b - a, 2).alias("difference_ms"),
        F.round(improvement, 2).alias("improvement_pct"),
        F.round(_rate(F.col("a_error_count"), F.col("a_total_requests")), 2).alias("error_rate_a"),
        F.round(_rate(F.col("b_error_count"), F.col("b_total_requests")), 2).alias("error_rate_b"),
    )


def ab_latency_quantile(log: DataFrame, p: float = 0.95, hot_rows: int | None = None) -> DataFrame:
    """Exact latency quantile per test and model, failed requests left out."""
    ok = log.filter(~F.col("error"))
    return exact_quantiles(ok, ["test_id", "model_name"], "latency_ms", {"p95_latency_ms": p}, hot_rows)


def ab_report(tests: DataFrame, log: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """One row per test and metric: model A, model B, improvement."""
    metrics = ab_metrics(log).join(ab_latency_quantile(log, hot_rows=hot_rows), ["test_id", "model_name"], "left")
    paired = ab_pairing(tests, metrics, [*_SIDE, "p95_latency_ms"])
    none = F.lit(None).cast("double")

    def both(name: str) -> tuple[Column, Column]:
        return F.col(f"a_{name}").cast("double"), F.col(f"b_{name}").cast("double")

    errors_a = _rate(F.col("a_error_count"), F.col("a_total_requests"))
    errors_b = _rate(F.col("b_error_count"), F.col("b_total_requests"))
    avg_a, avg_b = both("avg_prediction_time_ms")
    faster = F.when(avg_a > 0, (avg_a - avg_b) / avg_a * 100).otherwise(0.0)
    rows = [
        ("Total Requests", *both("total_requests"), none),
        ("Total Predictions", *both("total_predictions"), none),
        ("Avg Latency (ms)", avg_a, avg_b, faster),
        ("P95 Latency (ms)", *both("p95_latency_ms"), none),
        ("Min Latency (ms)", *both("min_prediction_time_ms"), none),
        ("Max Latency (ms)", *both("max_prediction_time_ms"), none),
        ("Error Count", *both("error_count"), none),
        ("Error Rate (%)", errors_a, errors_b, errors_a - errors_b),
        ("Success Rate (%)", 100 - errors_a, 100 - errors_b, none),
    ]
    return paired.select(
        "test_id",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), a.alias("model_a"), b.alias("model_b"), i.alias("improvement"))
                    for m, a, b, i in rows
                ]
            )
        ),
    )


def ab_traffic(paired: DataFrame) -> DataFrame:
    """Configured against observed share of each model."""
    total = F.col("a_total_requests") + F.col("b_total_requests")
    split = F.col("traffic_split")
    return paired.select(
        "test_id",
        F.inline(
            F.array(
                F.struct(
                    F.col("model_a").alias("model_name"), ((1 - split) * 100).alias("configured_pct"),
                    (F.col("a_total_requests") * 100 / total).alias("observed_pct"),
                ),
                F.struct(
                    F.col("model_b").alias("model_name"), (split * 100).alias("configured_pct"),
                    (F.col("b_total_requests") * 100 / total).alias("observed_pct"),
                ),
            )
        ),
    )


# --- statistical tests: samples are rows (test_id, variant A/B, value) -------------------------


def ab_samples(tests: DataFrame, log: DataFrame) -> DataFrame:
    """Latencies of successful requests with their variant."""
    config = tests.select("test_id", "model_a", "model_b")
    name = F.col("model_name")
    variant = F.when(name == F.col("model_a"), "A").when(name == F.col("model_b"), "B")
    return (
        log.filter(~F.col("error"))
        .join(config, "test_id")
        .select("test_id", variant.alias("variant"), F.col("latency_ms").alias("value"))
        .filter(F.col("variant").isNotNull())
    )


def ab_moments(samples: DataFrame) -> DataFrame:
    """Count, mean and sample variance of A and B per test, from one aggregate."""
    a = F.when(F.col("variant") == "A", F.col("value"))
    b = F.when(F.col("variant") == "B", F.col("value"))
    return samples.groupBy("test_id").agg(
        F.count(a).alias("n_a"), F.avg(a).alias("mean_a"), F.var_samp(a).alias("var_a"),
        F.count(b).alias("n_b"), F.avg(b).alias("mean_b"), F.var_samp(b).alias("var_b"),
    )


def _pooled_variance() -> Column:
    na, nb = F.col("n_a"), F.col("n_b")
    return F.try_divide((na - 1) * F.col("var_a") + (nb - 1) * F.col("var_b"), na + nb - 2)


def ab_ttest(moments: DataFrame) -> DataFrame:
    """Student's t with pooled variance, A minus B."""
    error = F.sqrt(_pooled_variance() * (1 / F.col("n_a") + 1 / F.col("n_b")))
    df = (F.col("n_a") + F.col("n_b") - 2).cast("double")
    tested = moments.filter((F.col("n_a") > 0) & (F.col("n_b") > 0) & (F.col("n_a") + F.col("n_b") > 2))
    return tested.select(
        "test_id", F.try_divide(F.col("mean_a") - F.col("mean_b"), error).alias("t_stat"), df.alias("df")
    ).withColumn("p_value", p_value("t_stat", "df"))


def ab_effect(moments: DataFrame) -> DataFrame:
    """Cohen's d and its usual wording."""
    d = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(_pooled_variance()))
    size = F.abs(F.col("cohens_d"))
    return moments.select("test_id", d.alias("cohens_d")).withColumn(
        "effect", F.when(size < 0.2, "small").when(size < 0.5, "medium").when(size.isNotNull(), "large")
    )


def ab_confidence_interval(moments: DataFrame, confidence: float = 0.95, critical: float | None = None) -> DataFrame:
    """Interval of mean A minus mean B; the critical value is a t quantile unless given."""
    error = F.sqrt(F.col("var_a") / F.col("n_a") + F.col("var_b") / F.col("n_b"))
    tested = moments.filter((F.col("n_a") > 1) & (F.col("n_b") > 1))
    df = (F.col("n_a") + F.col("n_b") - 2).cast("double")
    factor = F.lit(critical) if critical is not None else critical_t(F.lit(confidence), df)
    return tested.withColumns({"difference": F.col("mean_a") - F.col("mean_b"), "_margin": factor * error}).select(
        "test_id",
        "difference",
        (F.col("difference") - F.col("_margin")).alias("ci_lower"),
        (F.col("difference") + F.col("_margin")).alias("ci_upper"),
    )


def ab_sample_size(
    moments: DataFrame, effect: float = 0.05, alpha: float = 0.05, power: float = 0.8, comparisons: int = 1
) -> DataFrame:
    """Rows per variant to detect a relative change of `effect` in A's mean (Bonferroni over tests)."""
    z = NormalDist().inv_cdf(1 - alpha / comparisons / 2) + NormalDist().inv_cdf(power)
    delta = F.col("mean_a") * effect
    needed = F.try_divide(F.lit(2 * z * z) * _pooled_variance(), delta * delta)
    return moments.select(
        "test_id", "n_a", "n_b", needed.alias("needed"),
        (F.least("n_a", "n_b") >= needed).alias("enough"),
    )


def ab_chi2(paired: DataFrame) -> DataFrame:
    """Errors against successes of A and B, with Yates' correction."""
    ea, eb = F.col("a_error_count").cast("double"), F.col("b_error_count").cast("double")
    na, nb = F.col("a_total_requests").cast("double"), F.col("b_total_requests").cast("double")
    sa, sb = na - ea, nb - eb
    n = na + nb
    distance = F.abs(ea * sb - eb * sa)
    corrected = F.greatest(distance - n / 2, F.lit(0.0))
    chi2 = F.try_divide(n * corrected * corrected, (ea + eb) * (sa + sb) * na * nb)
    return paired.select("test_id", chi2.alias("chi2")).withColumn(
        "p_value", p_value(F.sqrt("chi2"), F.lit(None).cast("double"))
    )


def ab_mannwhitney(samples: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """U statistic of A over B; p-value by the normal approximation with ties and continuity."""
    weights = {v.lower(): (F.col("variant") == v).cast("int") for v in ("A", "B")}
    ranks = value_counts_running(samples, ["test_id"], "value", weights, hot_rows)
    here = (F.col("n_a") + F.col("n_b")).cast("double")
    sums = ranks.groupBy("test_id").agg(
        F.sum(F.col("n_a") * (F.col("b_b") + F.col("n_b") / 2)).alias("u_stat"),
        F.sum(here * here * here - here).alias("ties"),
        F.max("t_a").cast("double").alias("n_a"),
        F.max("t_b").cast("double").alias("n_b"),
    )
    na, nb, u = F.col("n_a"), F.col("n_b"), F.col("u_stat")
    n = na + nb
    spread = F.sqrt(na * nb / 12 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1))))
    z = F.try_divide(F.greatest(F.greatest(u, na * nb - u) - na * nb / 2 - 0.5, F.lit(0.0)), spread)
    return (
        sums.filter((na > 0) & (nb > 0))
        .select("test_id", "u_stat", z.alias("z"))
        .withColumn("p_value", p_value("z", F.lit(None).cast("double")))
    )


def ab_normality(samples: DataFrame) -> DataFrame:
    """Jarque-Bera statistic per test and variant; its p-value has a closed form."""
    n = F.count("value")
    jb = n / 6 * (F.pow(F.skewness("value"), 2) + F.pow(F.kurtosis("value"), 2) / 4)
    return (
        samples.groupBy("test_id", "variant")
        .agg(n.alias("n"), jb.alias("jarque_bera"))
        .withColumn("p_value", F.exp(-F.col("jarque_bera") / 2))
    )


def ab_shapiro(samples: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Shapiro-Wilk's W per test and variant, with Royston's weights and p-value.

    Weights depend on ranks alone, so rows with one value share a sum of weights: the work is per distinct value, and
    no sample is gathered in one task. Royston fitted the p-value up to 5,000 rows; beyond it is an extrapolation,
    beside which stands the Jarque-Bera test.
    """
    keys = ["test_id", "variant"]
    ranks = value_counts_running(samples, keys, "value", {"rows": F.lit(1)}, hot_rows)
    # Written, so that the rows of a heavy sample are joined to a table whose size Spark knows.
    means = materialise(
        samples.groupBy(*keys).agg(F.avg("value").alias("_mean"), (F.var_pop("value") * F.count("value")).alias("_squares")),
        "means",
    )
    v, below, rows, n = F.col("value"), F.col("b_rows"), F.col("n_rows"), F.col("t_rows")
    weighed = ranks.withColumn("_scores", inner_score_sum(below, rows, n)).join(means, keys)

    def at(rank: Column) -> Column:
        return F.max(F.when((below < rank) & (rank <= below + rows), v))

    sums = weighed.groupBy(*keys).agg(
        F.max(n).alias("n"),
        F.max("_squares").alias("_squares"),
        F.sum(F.col("_scores") * (v - F.col("_mean"))).alias("_inner"),
        *[at(r).alias(name) for name, r in (("_x1", F.lit(1)), ("_x2", F.lit(2)), ("_y2", n - 1), ("_y1", n))],
    )
    found = shapiro("n", "_squares", "_inner", "_x1", "_x2", "_y2", "_y1").alias("_found")
    return sums.select(*keys, "n", found).select(*keys, "n", F.col("_found.w").alias("w"), F.col("_found.p_value").alias("p_value"))


def ab_levene(samples: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Equality of variances: absolute deviations from the variant's median, then F."""
    medians = exact_quantiles(samples, ["test_id", "variant"], "value", {"_median": 0.5}, hot_rows)
    deviations = samples.join(medians, ["test_id", "variant"]).select(
        "test_id", "variant", F.abs(F.col("value") - F.col("_median")).alias("z")
    )
    per = deviations.groupBy("test_id", "variant").agg(
        F.count("z").cast("double").alias("n"), F.avg("z").alias("mean"), F.var_pop("z").alias("var")
    )
    n, mean, var = F.col("n"), F.col("mean"), F.col("var")
    sums = per.groupBy("test_id").agg(
        F.count(F.lit(1)).alias("k"), F.sum(n).alias("total"), F.sum(n * mean).alias("s"),
        F.sum(n * mean * mean).alias("ss"), F.sum(n * var).alias("within"),
    )
    between = F.col("ss") - F.col("s") * F.col("s") / F.col("total")
    free = F.col("total") - F.col("k")
    return (
        sums.filter((F.col("k") == 2) & (free > 0))
        .select("test_id", F.try_divide(between * free, F.col("within")).alias("f_stat"), free.alias("df"))
        .withColumn("p_value", p_value(F.sqrt(F.greatest("f_stat", F.lit(0.0))), "df"))
    )
