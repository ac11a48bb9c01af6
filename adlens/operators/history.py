"""Features of what a key did before each row, and of what its group does overall.

`compat` features are rates and gaps of whole tables, even where they use the row's own label; the
default training set is built from the leak-free ones.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.temporal import SECONDS_NEVER, seconds_between
from adlens.operators.encoders import N_FOLDS, SEED, fold_of, out_of_fold_mean, top_frequency
from adlens.operators.lookups import few_keys, grouped_tables, join_lookup
from adlens.operators.ordered import hot_values, running

TARGET = "clicked"
TS = "timestamp"
ROW_ID = "impression_id"


def global_mean(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.agg(F.avg(target).alias("_global_mean"))


def with_global_mean(df: DataFrame, mean: DataFrame) -> DataFrame:
    """Scalar on every row. Size bound: `mean` is one row."""
    return df.crossJoin(F.broadcast(mean))


def history_features(
    df: DataFrame,
    key: str,
    suffix: str = "",
    target: str = TARGET,
    row_id: str = ROW_ID,
    hot_rows: int | None = None,
) -> DataFrame:
    """Click rate and number of the key's strictly earlier impressions.

    A row without history gets the global rate. Rows at the same time are ordered by row id.
    """
    return key_features(df, key, suffix, target=target, row_id=row_id, hot_rows=hot_rows)


def histories(
    df: DataFrame,
    keys: Mapping[str, str],
    target: str = TARGET,
    row_id: str = ROW_ID,
    hot_rows: int | None = None,
) -> DataFrame:
    """`history_features` of several keys, given with their suffixes. Heavy keys and the mean are read from `df` itself."""
    hot = hot_values(df, list(keys), hot_rows)
    return heavy_first(
        df, list(keys), hot,
        lambda out, key: key_features(
            out, key, keys[key], target=target, row_id=row_id, hot_rows=hot_rows, hot=hot[key], source=df
        ),
    )


def heavy_first(
    df: DataFrame, keys: Sequence[str], hot: Mapping[str, list], add: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """`add` for every key, its columns in the order of `keys`. Rows of heavy keys are sampled for their ranges and
    written, so keys that have any come first: later, this would repeat and write the steps of the other keys."""
    out, added = df, {}
    for key in sorted(keys, key=lambda k: not hot[k]):
        before = set(out.columns)
        out = add(out, key)
        added[key] = [c for c in out.columns if c not in before]
    return out.select(*df.columns, *[c for key in keys for c in added[key]])


def user_timeline(
    df: DataFrame,
    user: str = "user_id",
    target: str = TARGET,
    row_id: str = ROW_ID,
    hot_rows: int | None = None,
) -> DataFrame:
    """Seconds since the user's previous impression and previous click.

    `time_since_last_click` is the usual feature: gap to the previous click on clicked rows,
    one year on all others, so it gives the label away. `time_since_click_safe` looks only at
    strictly earlier clicks, for every row alike.
    """
    ts, clicked = F.col(TS), F.col(target) == 1
    out = running(
        df, [user], [TS, row_id],
        lasts={"_seen": ts, "_click": F.when(clicked, ts)},
        hot_rows=hot_rows,
    )
    since_click = seconds_between(F.col("_click"), ts)
    return out.select(
        *df.columns,
        F.coalesce(seconds_between(F.col("_seen"), ts), F.lit(0.0)).alias("time_since_last_impression"),
        F.when(clicked, F.coalesce(since_click, F.lit(0.0)))
        .otherwise(F.lit(float(SECONDS_NEVER)))
        .alias("time_since_last_click"),
        F.coalesce(since_click, F.lit(float(SECONDS_NEVER))).alias("time_since_click_safe"),
    )


def key_features(
    df: DataFrame,
    key: str,
    suffix: str,
    activity: str | None = None,
    overall: str | None = None,
    timeline: bool = False,
    encode: bool = False,
    compat: bool = False,
    target: str = TARGET,
    row_id: str = ROW_ID,
    n_folds: int = N_FOLDS,
    seed: int = SEED,
    hot_rows: int | None = None,
    hot: list | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """All features of one key from a single shuffle.

    History always; `activity` names the column with the key's total rows; `overall` (compat only)
    the one with its whole-table rate; `timeline` adds the time since the previous rows; `encode`
    adds the key's frequency and out-of-fold target encodings. `hot` gives the heavy keys where the
    caller knows them. `source` is the narrow table `df` was made from: global figures are read
    from it instead of repeating the steps in between.
    """
    source = df if source is None else source
    y, ts, clicked = F.col(target), F.col(TS), F.col(target) == 1
    known = y.isNotNull().cast("int")
    fold = fold_of(F.col(row_id), n_folds, seed)
    totals: dict[str, Column] = {}
    if activity or encode:
        totals["_total_rows"] = F.lit(1)
    if overall and compat:
        totals |= {"_total_clicks": y, "_total_known": known}
    if encode:
        # Counts and sums of every fold over the whole key need no window of their own.
        for i in range(n_folds):
            totals[f"_n{i}"] = F.when(F.col("_fold") == i, known).otherwise(0)
            totals[f"_s{i}"] = F.when(F.col("_fold") == i, F.coalesce(y, F.lit(0))).otherwise(0)
    out = running(
        df.withColumn("_fold", fold) if encode else df, [key], [TS, row_id],
        sums={"_clicks": y, "_rows": F.lit(1), "_known": known},
        lasts={"_seen": ts, "_click": F.when(clicked, ts)} if timeline else {},
        totals=totals, hot_rows=hot_rows, hot=hot,
    )
    mean = global_mean(source, target).scalar()
    columns = {
        f"ctr_{key}{suffix}": F.coalesce(F.try_divide("_clicks", "_known"), mean),
        f"impressions_{key}{suffix}": F.col("_rows"),
    }
    if activity:
        columns[activity] = F.col("_total_rows")
    if overall and compat:
        columns[overall] = F.try_divide("_total_clicks", "_total_known")
    if timeline:
        never = F.lit(float(SECONDS_NEVER))
        since_click = seconds_between(F.col("_click"), ts)
        columns["time_since_last_impression"] = F.coalesce(seconds_between(F.col("_seen"), ts), F.lit(0.0))
        if compat:
            gap = F.coalesce(since_click, F.lit(0.0))
            columns["time_since_last_click"] = F.when(clicked, gap).otherwise(never)
        else:
            columns["time_since_click_safe"] = F.coalesce(since_click, never)
    if encode:
        frequency = F.coalesce("_total_rows", F.lit(0))
        columns[f"{key}_freq"] = frequency
        columns[f"{key}_freq_norm"] = F.coalesce(F.try_divide(frequency, top_frequency(source, key)), F.lit(0.0))
        columns[f"{key}_target_enc"] = F.coalesce(out_of_fold_mean(F.col("_fold"), n_folds), mean)
    return out.select(*df.columns, *[c.alias(n) for n, c in columns.items()])


def click_gap_merge(
    df: DataFrame, user: str = "user_id", target: str = TARGET, row_id: str = ROW_ID, hot_rows: int | None = None
) -> DataFrame:
    """Click gaps joined back on (user, timestamp).

    Several clicks of one user at one time repeat every row of that time.
    """
    ts = F.col(TS)
    clicks = df.filter(F.col(target) == 1).select(user, TS, row_id)
    gaps = running(clicks, [user], [TS, row_id], lasts={"_click": ts}, hot_rows=hot_rows).select(
        user,
        TS,
        F.coalesce(seconds_between(F.col("_click"), ts), F.lit(0.0)).alias("time_since_last_click"),
    )
    return df.join(gaps, [user, TS], "left").fillna({"time_since_last_click": float(SECONDS_NEVER)})


def group_means(
    df: DataFrame,
    groups: Mapping[str, Sequence[str]],
    target: str = TARGET,
    fill_global: Sequence[str] = (),
    source: DataFrame | None = None,
) -> DataFrame:
    """Mean target of a whole group on each of its rows, for several groupings.

    All groupings and the global mean come from one aggregate over a narrow table, which is written and joined back.
    `source` is the narrow table `df` was made from, if there is one.
    """
    base = df if source is None else source
    keys = dict.fromkeys(k for own in groups.values() for k in own)
    tables, whole = grouped_tables(base.select(*keys, F.col(target).alias("_y")), groups, {"_mean": F.avg("_y")})
    out = df
    for name, own in groups.items():
        out = join_lookup(out, tables[name].withColumnRenamed("_mean", name), own, False)
    mean = whole.agg(F.max("_mean")).scalar() if fill_global else None
    return out.select(
        *df.columns, *[F.coalesce(F.col(n), mean).alias(n) if n in fill_global else F.col(n) for n in groups]
    )


# Names of the whole-group rates.
GROUP_RATES = {
    "user_ctr_overall": ["user_id"],
    "ad_ctr_overall": ["ad_id"],
    "device_ctr_overall": ["device"],
    "placement_ctr_overall": ["placement"],
    "device_placement_ctr": ["device", "placement"],
    "user_device_ctr": ["user_id", "device"],
    "hour_placement_ctr": ["hour", "placement"],
}


def group_rates(df: DataFrame, target: str = TARGET) -> DataFrame:
    """All whole-group click rates; pair rates fall back to the global rate."""
    return group_means(df, GROUP_RATES, target, fill_global=("user_device_ctr", "hour_placement_ctr"))


def apply_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], value: str, default: Column) -> DataFrame:
    """A stored key-to-value table applied to rows; unseen and null keys get `default`."""
    small = few_keys(lookup, [keys])[0]
    return join_lookup(df, lookup, keys, small).withColumn(value, F.coalesce(F.col(value), default))


def unseen_keys(df: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of the rows that a stored table does not know."""
    return df.select(*keys).distinct().join(lookup, list(keys), "left_anti")
