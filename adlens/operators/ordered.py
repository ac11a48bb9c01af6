"""Running values, last-n rows and exact quantiles that hold up under key skew.

A window partitioned by a key puts all rows of the key in one task. That is the best plan while
keys are small, and an impossible one when a key holds a third of the table. Every function here
first asks for the heavy keys (by summaries of bounded size) and sends only those through a
second path, in which rows are range-partitioned by key *and* order, so that no task is larger
than another however the keys are distributed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlens.operators.heavy import heavy_keys
from adlens.sources.materialise import materialise

#: Rows of a key that one task may sort; their size, and so the memory of the task, depends on the columns.
HOT_ROWS = 500_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> list:
    """All keys with more than `hot_rows` rows, heaviest first, with their row counts."""
    return heavy_keys(df, [keys], hot_rows or HOT_ROWS)[0]


def hot_values(df: DataFrame, columns: Sequence[str], hot_rows: int | None = None) -> dict[str, list]:
    """`hot_keys` of several single-column keys from one scan."""
    return dict(zip(columns, heavy_keys(df, [[c] for c in columns], hot_rows or HOT_ROWS), strict=True)) if columns else {}


def split_hot(df: DataFrame, keys: Sequence[str], hot: list) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys and rows of the given hot keys; rows with a null key are ordinary."""
    schema = df.select(*keys).schema
    # Size bound: a key of this table holds more than `hot_rows` rows, so they are few beside the rows.
    table = F.broadcast(
        df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in hot], schema)
    )
    return df.join(table, list(keys), "left_anti"), df.join(table, list(keys), "left_semi")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    inclusive: bool = False,
    hot_rows: int | None = None,
    hot: list | None = None,
    segments: int | None = None,
) -> DataFrame:
    """Add running values per key in ascending `order`, which must be unique within a key.

    `sums`: sum of an expression over the earlier rows (0 when there is none).
    `lasts`: latest non-null value of an expression among the earlier rows.
    `totals`: sum over all rows of the key.
    With `inclusive` the current row counts as an earlier one. All values of one call share one
    shuffle. Rows whose key is null get null values and take no part. `hot` gives the result of
    `hot_keys` where the caller knows it already; `segments` sets into how many ranges their rows
    are cut (0 leaves it to adaptive execution).
    """
    sums, lasts, totals = dict(sums or {}), dict(lasts or {}), dict(totals or {})
    keys, order = list(keys), list(order)
    if hot is None:
        hot = hot_keys(df, keys, hot_rows)
    if not hot:
        return _running_plain(df, keys, keys, order, sums, lasts, totals, inclusive)
    cold_rows, hot_rows_df = split_hot(df, keys, hot)
    if segments is None:
        segments = max(2, ceil(sum(r["_rows"] for r in hot) / (hot_rows or HOT_ROWS)))
    return _running_plain(cold_rows, keys, keys, order, sums, lasts, totals, inclusive).unionByName(
        _running_segmented(hot_rows_df, keys, order, sums, lasts, totals, inclusive, segments)
    )


def _running_plain(df, keys, partition, order, sums, lasts, totals, inclusive) -> DataFrame:
    # A null key is no group. Spreading such rows over the order columns keeps them out of one
    # task; their values are overwritten with null below.
    nullable = [k for k in keys if df.schema[k].nullable]
    known = F.lit(True)
    for k in nullable:
        known = known & F.col(k).isNotNull()
    if nullable:
        df = df.withColumn("_spread", F.when(~known, F.xxhash64(*order)))
        partition = [*partition, "_spread"]
    # Shuffling before the expressions below keeps their values out of the shuffle.
    df = df.repartition(*partition)
    everything = W.partitionBy(*partition)
    frame = everything.orderBy(*order).rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    columns = {n: F.when(known, F.coalesce(F.sum(e).over(frame), F.lit(0))) for n, e in sums.items()}
    columns |= {n: F.when(known, F.last(e, ignorenulls=True).over(frame)) for n, e in lasts.items()}
    columns |= {n: F.when(known, F.sum(e).over(everything)) for n, e in totals.items()}
    return df.select(*[c for c in df.columns if c != "_spread"], *[c.alias(n) for n, c in columns.items()])


def _running_segmented(df, keys, order, sums, lasts, totals, inclusive, segments) -> DataFrame:
    # The segment number depends on the physical partitioning, so the rows are written once.
    ranges = [segments] if segments else []
    ranged = df.repartitionByRange(*ranges, *keys, *order)
    rows = materialise(ranged.withColumn("_segment", F.spark_partition_id()), "segments")
    local = _running_plain(rows, keys, [*keys, "_segment"], order, sums, lasts, {}, inclusive)
    position = F.struct(*order)
    per_segment = rows.groupBy(*keys, "_segment").agg(
        *[F.sum(e).alias(f"_sum_{n}") for n, e in sums.items()],
        *[F.max_by(e, F.when(e.isNotNull(), position)).alias(f"_last_{n}") for n, e in lasts.items()],
        F.count(F.lit(1)).alias("_rows"),
    )
    earlier = W.partitionBy(*keys).orderBy("_segment").rowsBetween(W.unboundedPreceding, -1)
    carry = per_segment.select(
        *keys,
        "_segment",
        F.count(F.lit(1)).over(earlier).alias("_earlier"),
        *[F.sum(f"_sum_{n}").over(earlier).alias(f"_carry_{n}") for n in sums],
        *[F.last(f"_last_{n}", ignorenulls=True).over(earlier).alias(f"_carry_{n}") for n in lasts],
    ).filter("_earlier > 0")
    # Size bound: a segment is entered by at most one key that began in an earlier segment.
    out = local.join(F.broadcast(carry), [*keys, "_segment"], "left")
    if totals:
        whole = rows.groupBy(*keys).agg(*[F.sum(e).alias(n) for n, e in totals.items()])
        # Size bound: one row per hot key.
        out = out.join(F.broadcast(whole), keys, "left")
    return out.select(
        *df.columns,
        *[(F.col(n) + F.coalesce(f"_carry_{n}", F.lit(0))).alias(n) for n in sums],
        *[F.coalesce(F.col(n), F.col(f"_carry_{n}")).alias(n) for n in lasts],
        *totals,
    )


def last_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, lanes: int = 256, prune: bool = True
) -> DataFrame:
    """The `n` latest rows of every key by ascending `order`, exact for keys of any size.

    With a timestamp as first order column, rows per key and hour are counted first, and hours that
    cannot hold one of the latest `n` rows are left out before anything is shuffled. What remains
    is ranked by `lanes` tasks per key and then by one, which sees at most lanes * n rows. The lane
    is only a meeting point: any spread of rows over lanes gives the same result.
    """
    if prune and df.schema[order[0]].dataType.typeName().startswith("timestamp"):
        df = _recent_hours(df, keys, order[0], n)
    latest = [F.col(c).desc() for c in order]
    lane = df.withColumn("_lane", F.pmod(F.xxhash64(*order), F.lit(lanes)))
    by_lane = W.partitionBy(*keys, "_lane").orderBy(*latest)
    by_key = W.partitionBy(*keys).orderBy(*latest)
    return (
        lane.withColumn("_rank", F.row_number().over(by_lane))
        .filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(by_key))
        .filter(F.col("_rank") <= n)
        .drop("_lane", "_rank")
    )


def _recent_hours(df: DataFrame, keys: Sequence[str], ts: str, n: int) -> DataFrame:
    """Rows from the latest hour on that still has `n` rows of the key at or after it."""
    hour = F.timestamp_diff("HOUR", F.lit("1970-01-01").cast(df.schema[ts].dataType), F.col(ts))
    # Rows without a time are the oldest.
    marked = df.withColumn("_hour", F.coalesce(hour, F.lit(-(10**9))))
    own = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    names = [f"_key{i}" for i in range(len(keys))]
    cells = marked.groupBy(*own, "_hour").agg(F.count(F.lit(1)).alias("_rows"))
    later = W.partitionBy(*names).orderBy(F.desc("_hour")).rowsBetween(W.unboundedPreceding, -1)
    after = F.coalesce(F.sum("_rows").over(later), F.lit(0))
    needed = cells.withColumn("_after", after).filter(F.col("_after") < n)
    # One row per key, written so that Spark knows its size when it plans the join.
    cutoffs = materialise(needed.groupBy(*names).agg(F.min("_hour").alias("_cutoff")), "cutoffs")
    match = F.col("_hour") >= F.col("_cutoff")
    for k, name in zip(keys, names):
        match &= F.col(k).eqNullSafe(F.col(name))
    return marked.join(cutoffs, match).select(*df.columns)


def value_counts_running(
    df: DataFrame, keys: Sequence[str], value: str, weights: Mapping[str, Column], hot_rows: int | None = None
) -> DataFrame:
    """One row per key and distinct value, with the weights summed at it (`n_*`) and below it (`b_*`).

    Ties collapse in the map-side combine before anything is ordered. Heavy keys are looked for in
    the rows, where that is cheap; they have at least as many rows as distinct values.
    """
    present = df.filter(F.col(value).isNotNull())
    tied = present.groupBy(*keys, value).agg(*[F.sum(w).alias(f"n_{n}") for n, w in weights.items()])
    return running(
        tied,
        keys,
        [value],
        sums={f"b_{n}": F.col(f"n_{n}") for n in weights},
        totals={f"t_{n}": F.col(f"n_{n}") for n in weights},
        hot=hot_keys(present, keys, hot_rows),
        segments=0,
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    hot_rows: int | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles per key, one column per entry of `probabilities`.

    The ranks come from running counts over distinct values, so no task holds a whole key.
    """
    ranked = value_counts_running(df, keys, value, {"rows": F.lit(1)}, hot_rows)
    v, below, here, total = F.col(value), F.col("b_rows"), F.col("n_rows"), F.col("t_rows")
    picks, results = [], []
    for name, p in probabilities.items():
        target = (total - 1) * F.lit(float(p))
        low, high = F.floor(target), F.ceil(target)
        at = lambda rank: (below <= rank) & (rank < below + here)
        picks += [
            F.max(F.when(at(low), v)).alias(f"_low_{name}"),
            F.max(F.when(at(high), v)).alias(f"_high_{name}"),
            F.max(target - low).alias(f"_part_{name}"),
        ]
        lo, hi = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        results.append((lo + (hi - lo) * F.col(f"_part_{name}")).alias(name))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *results)
