"""Profiling of impressions and predictions: rates, balances, distributions, reports.

Everything is a map-side combined aggregate; nothing holds a group in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.operators.brackets import RANK_ERROR, bracket_ends, exact_in_brackets, sketch_of
from adlens.operators.lookups import few_keys, join_lookup
from adlens.operators.normalize import numeric_columns
from adlens.schemas import DAY_NAMES
from adlens.sources.materialise import materialise

TARGET = "clicked"


def overall_ctr(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.agg(F.avg(target).alias("ctr"))


def ctr_by(df: DataFrame, *keys: str, target: str = TARGET) -> DataFrame:
    """Click rate and impressions per key."""
    return df.groupBy(*keys).agg(F.avg(target).alias("ctr"), F.count(F.lit(1)).alias("impressions"))


def ctr_by_day_of_week(df: DataFrame, target: str = TARGET) -> DataFrame:
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    return ctr_by(df, "day_of_week", target=target).withColumn(
        "day_name", F.element_at(names, F.col("day_of_week") + 1)
    )


def sorted_report(report: DataFrame, *by: str, descending: bool = True) -> DataFrame:
    return report.orderBy(*[F.desc(c) if descending else F.asc(c) for c in by])


def ctr_pivot(
    df: DataFrame,
    rows: str = "device",
    columns: str = "placement",
    values: Sequence[str] = (),
    target: str = TARGET,
) -> DataFrame:
    """Matrix of click rates. Naming the column values saves the job that finds them."""
    return df.groupBy(rows).pivot(columns, list(values) or None).agg(F.avg(target))


def with_share(counts: DataFrame, whole: DataFrame, name: str = "percentage") -> DataFrame:
    """Percentage of each count in the total; `whole` is a one-row table with `_total`."""
    # Size bound: one row.
    return counts.crossJoin(F.broadcast(whole)).select(
        *counts.columns, (F.col("count") * 100 / F.col("_total")).alias(name)
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return with_share(counts, counts.agg(F.sum("count").alias("_total")))


def class_balance(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Count and share of all rows per class, with the overall click rate on every row."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    whole = counts.agg(
        F.sum("count").alias("_total"),
        (F.sum(F.col(target) * F.col("count")) / F.sum("count")).alias("_ctr"),
    )
    # Size bound: one row.
    return counts.crossJoin(F.broadcast(whole)).select(
        target,
        "count",
        (F.col("count") * 100 / F.col("_total")).alias("percentage"),
        F.col("_ctr").alias("ctr"),
    )


def class_weight(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows of class 0 per row of class 1: the weight that balances the classes."""
    return df.agg(
        F.try_divide(F.count_if(F.col(target) == 0), F.count_if(F.col(target) == 1)).alias("scale_pos_weight")
    )


def _per_column(df: DataFrame, aggregates: Mapping[str, Mapping[str, Column]], by: str = "column") -> DataFrame:
    """One row per column from one aggregate over all of them."""
    one_row = df.agg(
        *[agg.alias(f"{c}\x1f{a}") for c, aggs in aggregates.items() for a, agg in aggs.items()]
    )
    names = list(next(iter(aggregates.values())))
    rows = F.array(
        *[
            F.struct(F.lit(c).alias(by), *[F.col(f"`{c}\x1f{a}`").alias(a) for a in names])
            for c in aggregates
        ]
    )
    return one_row.select(F.inline(rows))


def _is_missing(df: DataFrame, column: str) -> Column:
    missing = F.col(column).isNull()
    if dict(df.dtypes)[column] in ("double", "float"):
        missing = missing | F.isnan(column)
    return missing


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and percentage per column, most missing first."""
    share = lambda n: F.coalesce(F.try_divide(n * 100, F.count(F.lit(1))), F.lit(0.0))
    counts = {c: F.count_if(_is_missing(df, c)) for c in df.columns}
    report = _per_column(
        df, {c: {"missing_count": n, "missing_percentage": share(n)} for c, n in counts.items()}
    )
    return report.orderBy(F.desc("missing_count"), "column")


def only_missing(report: DataFrame) -> DataFrame:
    return report.filter(F.col("missing_count") > 0)


def nonfinite_report(df: DataFrame) -> DataFrame:
    """NaN and infinity counts per floating-point column."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    inf = float("inf")
    return _per_column(
        df,
        {
            c: {
                "nan_count": F.count_if(F.isnan(c)),
                "inf_count": F.count_if(F.col(c).isin(inf, -inf)),
            }
            for c in floats
        },
    )


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True, accuracy: int = 10_000
) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column.

    Two scans: all figures and a sketch of each column, then the values near the quartiles. `exact=False` takes
    the quartiles from mergeable sketches in the single pass of the other figures.
    """
    columns = list(columns or numeric_columns(df))
    quarters = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    usable = {c: F.when(~_is_missing(df, c), F.col(c).cast("double")) for c in columns}

    def figures(value: Column) -> dict[str, Column]:
        out = {
            "count": F.count(value),
            "mean": F.avg(value),
            "std": F.stddev_samp(value),
            "min": F.min(value),
            "max": F.max(value),
        }
        if exact:
            out["sketch"] = sketch_of(value)
        else:
            out |= {n: F.percentile_approx(value, p, accuracy) for n, p in quarters.items()}
        return out

    report = _per_column(df, {c: figures(v) for c, v in usable.items()})
    if exact:
        ends = [e.alias(f"{n}{side}") for n, p in quarters.items() for side, e in enumerate(bracket_ends(F.col("sketch"), p, 3 * RANK_ERROR))]
        # Size bound: one row per column.
        rows = {r["column"]: r for r in report.select("column", "count", "mean", "std", "min", "max", *ends).collect()}
        found = exact_in_brackets(
            df.select(*[v.alias(c) for c, v in usable.items()]),
            {c: r["count"] for c, r in rows.items()},
            {(c, p): (r[f"{n}0"], r[f"{n}1"]) for c, r in rows.items() for n, p in quarters.items()},
        )
        names = ("count", "mean", "std", "min", *quarters, "max")
        lines = [(c, *[found[c, quarters[n]] if n in quarters else r[n] for n in names]) for c, r in rows.items()]
        schema = "column string, " + ", ".join(f"{n} {'long' if n == 'count' else 'double'}" for n in names)
        return df.sparkSession.createDataFrame(lines, schema)
    return report.select("column", "count", "mean", "std", "min", *quarters, "max")


def table_info(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Rows, columns and time span."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.min(ts).alias("start"),
        F.max(ts).alias("end"),
        F.floor(F.timestamp_diff("SECOND", F.min(ts), F.max(ts)) / 86400).cast("bigint").alias("span_days"),
    )


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def entity_stats(df: DataFrame, entities: Sequence[str] = ("user_id", "ad_id"), approx: bool = False) -> DataFrame:
    """Distinct entities and mean impressions of each.

    Exact counts group by the entity first, so that a heavy one is combined on the map side.
    """
    parts = []
    for entity in entities:
        if approx:
            one = df.agg(
                F.approx_count_distinct(entity).alias("distinct_count"),
                F.count(F.lit(1)).alias("impressions"),
            )
        else:
            one = (
                df.groupBy(entity)
                .agg(F.count(F.lit(1)).alias("n"))
                .agg(F.count(entity).alias("distinct_count"), F.sum("n").alias("impressions"))
            )
        parts.append(
            one.select(
                F.lit(entity).alias("entity"),
                "distinct_count",
                F.try_divide("impressions", "distinct_count").alias("avg_impressions"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def top_entities(df: DataFrame, entity: str, n: int = 10) -> DataFrame:
    """The entities with most impressions; ties go to the smaller key."""
    return (
        df.filter(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(F.count(F.lit(1)).alias("impressions"))
        .orderBy(F.desc("impressions"), entity)
        .limit(n)
    )


def freq_vs_ctr(df: DataFrame, entity: str = "user_id", target: str = TARGET, n: int = 10) -> DataFrame:
    """Impressions and click rate of the most frequent entities."""
    return (
        df.filter(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(F.count(F.lit(1)).alias("freq"), F.avg(target).alias("ctr"))
        .orderBy(F.desc("freq"), entity)
        .limit(n)
    )


def trend_line(df: DataFrame, entity: str = "user_id", target: str = TARGET) -> DataFrame:
    """Least-squares line of the target on the entity's frequency, over all rows.

    All rows of entities that are equally frequent share one point, so rows shrink to entities and those to distinct
    frequencies, which are written once; the sums are then taken around the means.
    """
    per = df.filter(F.col(entity).isNotNull()).groupBy(entity).agg(
        F.count(F.lit(1)).alias("f"), F.sum(target).cast("double").alias("y")
    )
    points = materialise(
        per.groupBy(F.col("f").cast("double").alias("f")).agg(
            F.sum("f").cast("double").alias("w"), F.sum("y").alias("y")
        ),
        "frequencies",
    )
    means = points.agg(
        (F.sum(F.col("w") * F.col("f")) / F.sum("w")).alias("mf"), (F.sum("y") / F.sum("w")).alias("my")
    )
    # Size bound: one row.
    gap = F.col("f") - F.col("mf")
    sums = points.crossJoin(F.broadcast(means)).agg(
        F.sum(gap * (F.col("y") - F.col("w") * F.col("my"))).alias("sxy"),
        F.sum(F.col("w") * gap * gap).alias("sxx"),
        F.first("mf").alias("mf"),
        F.first("my").alias("my"),
    )
    slope = F.try_divide("sxy", "sxx")
    return sums.select(slope.alias("slope"), (F.col("my") - slope * F.col("mf")).alias("intercept"))


def value_histogram(
    df: DataFrame, value: str, bins: int, low: float, high: float, by: Sequence[str] = ()
) -> DataFrame:
    """Counts in `bins` equal bins of [low, high]; the upper end belongs to the last bin."""
    position = F.floor((F.col(value) - F.lit(low)) * bins / F.lit(high - low))
    return (
        df.filter(F.col(value).between(low, high))
        .groupBy(*by, F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def user_target_stats(df: DataFrame, entity: str = "user_id", target: str = TARGET) -> DataFrame:
    """Mean, sample deviation and sum of the target per entity."""
    return df.groupBy(entity).agg(
        F.avg(target).alias("user_ctr_mean"),
        F.stddev_samp(target).alias("user_ctr_std"),
        F.sum(target).alias("user_clicks_total"),
    )


def join_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put group statistics onto rows."""
    return join_lookup(df, stats, keys, few_keys(df, [keys])[0])


def activity_level(df: DataFrame, entity: str, name: str) -> DataFrame:
    """Row count of the entity on every row."""
    counts = df.groupBy(entity).agg(F.count(F.lit(1)).alias(name))
    return join_stats(df, counts, [entity])


def pair_count(df: DataFrame, a: str = "user_id", b: str = "ad_id", name: str = "user_ad_interaction_count") -> DataFrame:
    counts = df.groupBy(a, b).agg(F.count(F.lit(1)).alias(name))
    return join_stats(df, counts, [a, b])


def click_ratio(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Clicks of the user per click of the ad (plus one)."""
    users = df.groupBy("user_id").agg(F.sum(target).alias("user_clicks"))
    ads = df.groupBy("ad_id").agg(F.sum(target).alias("ad_clicks"))
    few_users, few_ads = few_keys(df, [["user_id"], ["ad_id"]])
    joined = join_lookup(join_lookup(df, users, ["user_id"], few_users), ads, ["ad_id"], few_ads)
    return joined.withColumn("user_ad_click_ratio", F.col("user_clicks") / (F.col("ad_clicks") + 1))


def device_rollup(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("device")
        .agg(
            F.avg("predicted_ctr").alias("avg_predicted_ctr"),
            F.avg("actual_ctr").alias("avg_actual_ctr"),
            F.count(F.lit(1)).alias("prediction_count"),
        )
        .orderBy(F.desc("avg_predicted_ctr"))
    )


def with_feedback(predictions: DataFrame) -> DataFrame:
    return predictions.filter(F.col("actual_ctr").isNotNull())


def model_mae(predictions: DataFrame) -> DataFrame:
    return (
        with_feedback(predictions)
        .groupBy("model_name")
        .agg(
            F.avg("predicted_ctr").alias("avg_prediction"),
            F.avg(F.abs(F.col("predicted_ctr") - F.col("actual_ctr"))).alias("mae"),
            F.count(F.lit(1)).alias("total_predictions"),
        )
        .orderBy("mae")
    )


def hourly_series(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy(F.date_trunc("HOUR", "timestamp").cast("timestamp_ntz").alias("hour"))
        .agg(F.avg("predicted_ctr").alias("avg_ctr"), F.count(F.lit(1)).alias("request_count"))
        .orderBy("hour")
    )


def latest_n(df: DataFrame, n: int = 10, order: Sequence[str] = ("timestamp", "request_id")) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def prediction_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("prediction_count"))
