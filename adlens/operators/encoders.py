"""Encodings of high-cardinality keys: frequency, out-of-fold target mean, hash indicators.

The fitted state of a key column is one table, one row per key value. Fitting all of them is one map-side
combined aggregate and applying each is one join, whatever the number of folds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions.hashing import hash_bucket, md5_mod
from adlens.operators.lookups import few_keys, grouped_tables, join_lookup

TARGET = "clicked"
ROW_ID = "impression_id"
N_FOLDS = 5
SEED = 42
HIGH_CARDINALITY = 100
HASH_CARDINALITY = 1000
N_HASHED = 10


def fold_of(row_id: Column, n_folds: int = N_FOLDS, seed: int = SEED) -> Column:
    """Cross-validation fold of a row, from its id alone."""
    return hash_bucket(F.concat(F.lit(f"{seed}:"), row_id.cast("string")), n_folds)


def kfold_assign(df: DataFrame, row_id: str = ROW_ID, n_folds: int = N_FOLDS, seed: int = SEED) -> DataFrame:
    return df.withColumn("fold", fold_of(F.col(row_id), n_folds, seed))


def fit_frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a key and its share of the most frequent value's count."""
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(f"{column}_freq"))
    )
    top = counts.agg(F.max(f"{column}_freq")).scalar()
    return counts.withColumn(f"{column}_freq_norm", F.col(f"{column}_freq") / top)


def top_frequency(df: DataFrame, column: str) -> Column:
    """Rows of the most frequent value, as a scalar subquery."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.max("_n")).scalar()


def apply_frequency(df: DataFrame, state: DataFrame, column: str) -> DataFrame:
    """Unseen and null keys have frequency 0."""
    lookup = state.select(column, f"{column}_freq", f"{column}_freq_norm")
    joined = join_lookup(df, lookup, [column], few_keys(state, [[column]])[0])
    return joined.fillna(0, subset=[f"{column}_freq", f"{column}_freq_norm"])


def frequency_encode(df: DataFrame, column: str) -> DataFrame:
    small = few_keys(df, [[column]])[0]
    return join_lookup(df, fit_frequency(df, column), [column], small).fillna(
        0, subset=[f"{column}_freq", f"{column}_freq_norm"]
    )


@dataclass(frozen=True)
class KeyState:
    """Fitted encodings of one key column.

    `table`: key value, frequency, normalised frequency, target mean, and the count and target
    sum of every fold. `global_mean`: one row. `small`: the table was checked to fit a broadcast; a table that was
    written needs no such check, Spark knows its size.
    """

    column: str
    table: DataFrame
    global_mean: DataFrame
    hashed: bool
    small: bool = False


def fit_keys(
    df: DataFrame,
    columns: Sequence[str],
    target: str = TARGET,
    row_id: str = ROW_ID,
    n_folds: int = N_FOLDS,
    seed: int = SEED,
    hashed: Sequence[str] | None = (),
) -> list[KeyState]:
    """States of several key columns from one scan: one aggregate with a grouping per column and one of all rows.

    Without a list of `hashed` columns those with over HASH_CARDINALITY values are, as counted in the states.
    """
    if not columns:
        return []
    y, fold = F.col("_y"), F.col("_fold")
    folded = df.select(*dict.fromkeys(columns), F.col(target).alias("_y"), fold_of(F.col(row_id), n_folds, seed).alias("_fold"))
    aggregates = {"_rows": F.count(F.lit(1)), "_mean": F.avg(y)}
    for i in range(n_folds):
        aggregates[f"_n{i}"] = F.count(F.when(fold == i, y))
        aggregates[f"_s{i}"] = F.coalesce(F.sum(F.when(fold == i, y)), F.lit(0))
    tables, whole = grouped_tables(folded, {c: [c] for c in columns}, aggregates)
    known = {c: t.filter(F.col(c).isNotNull()) for c, t in tables.items()}
    if hashed is None:
        hashed = [c for c, t in known.items() if t.count() > HASH_CARDINALITY]
    # Over no rows there is still a row, with a null mean.
    mean = whole.agg(F.max("_mean").alias("_global_mean"))
    states = []
    for c, counts in known.items():
        top = counts.agg(F.max("_rows")).scalar()
        table = counts.select(
            c, F.col("_rows").alias(f"{c}_freq"), F.col("_mean").alias(f"{c}_mean"),
            *[f"_{k}{i}" for i in range(n_folds) for k in "ns"], (F.col("_rows") / top).alias(f"{c}_freq_norm"),
        )
        states.append(KeyState(c, table, mean, c in hashed))
    return states


def fit_key(df: DataFrame, column: str, *args, hashed: bool = False, **options) -> KeyState:
    """`fit_keys` for one column."""
    return fit_keys(df, [column], *args, hashed=[column] if hashed else (), **options)[0]


def encode_fitted(
    df: DataFrame,
    state: KeyState,
    row_id: str = ROW_ID,
    n_folds: int = N_FOLDS,
    seed: int = SEED,
    out_of_fold: bool = True,
) -> DataFrame:
    """Apply a key's state: frequencies, target encoding, and hash indicators if it has them.

    For the rows the state was fitted on, the encoding leaves out the row's own fold: what the
    fold holds is subtracted from the total, so no pass per fold is needed. For other rows
    (`out_of_fold=False`) it is the stored mean. Keys without a value get the global mean.
    """
    c = state.column
    joined = join_lookup(df, state.table, [c], state.small)
    if out_of_fold:
        joined = joined.withColumn("_fold", fold_of(F.col(row_id), n_folds, seed))
        encoded = out_of_fold_mean(F.col("_fold"), n_folds)
    else:
        encoded = F.col(f"{c}_mean")
    mean = state.global_mean.select("_global_mean").scalar()
    if state.hashed:
        joined = joined.withColumn("_bucket", _bucket_of(c))
    return joined.select(
        *df.columns,
        F.coalesce(f"{c}_freq", F.lit(0)).alias(f"{c}_freq"),
        F.coalesce(f"{c}_freq_norm", F.lit(0.0)).alias(f"{c}_freq_norm"),
        F.coalesce(encoded, mean).alias(f"{c}_target_enc"),
        *(_indicators(c) if state.hashed else []),
    )


def out_of_fold_mean(fold: Column, n_folds: int) -> Column:
    """Target mean of a key without the row's own fold, from the columns `_n{i}` and `_s{i}`."""
    n_all = sum((F.col(f"_n{i}") for i in range(1, n_folds)), F.col("_n0"))
    s_all = sum((F.col(f"_s{i}") for i in range(1, n_folds)), F.col("_s0"))
    own_n = F.element_at(F.array(*[F.col(f"_n{i}") for i in range(n_folds)]), fold + 1)
    own_s = F.element_at(F.array(*[F.col(f"_s{i}") for i in range(n_folds)]), fold + 1)
    return F.try_divide(s_all - own_s, n_all - own_n)


def target_encode_oof(df: DataFrame, column: str, target: str = TARGET, row_id: str = ROW_ID, n_folds: int = N_FOLDS, seed: int = SEED) -> DataFrame:
    state = fit_key(df, column, target, row_id, n_folds, seed)
    encoded = encode_fitted(df, state, row_id, n_folds, seed)
    return encoded.select(*df.columns, f"{column}_target_enc")


def target_encode_apply(df: DataFrame, state: KeyState) -> DataFrame:
    encoded = encode_fitted(df, state, out_of_fold=False)
    return encoded.select(*df.columns, f"{state.column}_target_enc")


def _bucket_of(column: str, n_features: int = N_HASHED) -> Column:
    return md5_mod(F.coalesce(F.col(column).cast("string"), F.lit("nan")), n_features)


def _indicators(column: str, n_features: int = N_HASHED) -> list[Column]:
    return [F.when(F.col("_bucket") == i, 1).otherwise(0).alias(f"{column}_hash_{i}") for i in range(n_features)]


def hash_features(df: DataFrame, column: str, n_features: int = N_HASHED) -> DataFrame:
    """Indicator columns of the key's hash bucket; the key is hashed once per row."""
    return df.withColumn("_bucket", _bucket_of(column, n_features)).select(*df.columns, *_indicators(column, n_features))


def distinct_counts(df: DataFrame, columns: Sequence[str], near: Sequence[int] = (HIGH_CARDINALITY, HASH_CARDINALITY), rsd: float = 0.05) -> dict[str, int]:
    """Distinct values per column: sketched in one pass, recounted only near a threshold.

    A recount groups a column of about `near` distinct values, so its map-side result is small.
    """
    columns = list(columns)
    if not columns:
        return {}
    sketch = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns]).first().asDict()
    margin = 1 + 6 * rsd
    doubtful = [c for c in columns if any(n / margin <= sketch[c] <= n * margin for n in near)]
    if doubtful:
        sketch |= df.agg(*[F.count_distinct(c).alias(c) for c in doubtful]).first().asDict()
    return sketch


def detect_high_cardinality(df: DataFrame, target: str = TARGET, exclude: Sequence[str] = ()) -> dict[str, int]:
    """String and bigint columns with more than 100 distinct values, and how many they have."""
    candidates = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.LongType)) and f.name not in (target, *exclude)
    ]
    counts = distinct_counts(df, candidates)
    return {c: n for c, n in counts.items() if n > HIGH_CARDINALITY}


def encode_all(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    hashed: Sequence[str] | None = None,
    target: str = TARGET,
    row_id: str = ROW_ID,
    n_folds: int = N_FOLDS,
    seed: int = SEED,
    source: DataFrame | None = None,
    done: Sequence[str] = (),
) -> tuple[DataFrame, list[KeyState]]:
    """Encode every listed key column; detect the columns when none are listed.

    The rows are read twice: once by the aggregate of all keys, which is written, and once to join it. Without a list
    columns over 1000 values are hashed too.
    `source` is the narrow table `df` was made from: keys it has are fitted on it. The keys in
    `done` are encoded already and only get their state and hash indicators.
    """
    source = df if source is None else source
    if columns is None:
        found = detect_high_cardinality(df, target, exclude=[row_id])
        columns = list(found)
        if hashed is None:
            hashed = [c for c, n in found.items() if n > HASH_CARDINALITY]
    columns = [c for c in columns if c in df.columns]
    by_column = {}
    for rows, own in ((source, [c for c in columns if c in source.columns]), (df, [c for c in columns if c not in source.columns])):
        by_column |= {s.column: s for s in fit_keys(rows, own, target, row_id, n_folds, seed, hashed)}
    states = [by_column[c] for c in columns]
    for state in states:
        if state.column not in done:
            df = encode_fitted(df, state, row_id, n_folds, seed)
        elif state.hashed:
            df = hash_features(df, state.column)
    return df, states
