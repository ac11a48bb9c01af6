"""Feature table: fit on a labelled log, store the state as tables, apply it to new rows.

The default set uses nothing but earlier rows and out-of-fold means. With `compat` it has
whole-table rates and the label-dependent click gap as well.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlens.functions.temporal import SECONDS_NEVER, seconds_between
from adlens.operators import encoders, history
from adlens.operators.normalize import interaction_key, temporal_features
from adlens.operators.ordered import hot_values
from adlens.operators.selection import Selection, select_features
from adlens.sources.materialise import materialise

TS = "timestamp"

# Key columns with their feature suffix, activity column and whole-table rate.
KEYS = {
    "user_id": ("_user", "user_activity_level", "user_ctr_overall"),
    "ad_id": ("_ad", "ad_impression_count", "ad_ctr_overall"),
    "device": ("_device", None, "device_ctr_overall"),
}
PAIR_RATES = {n: c for n, c in history.GROUP_RATES.items() if len(c) > 1 or c == ["placement"]}
FILL_GLOBAL = ("user_device_ctr", "hour_placement_ctr")


@dataclass(frozen=True)
class FeatureOptions:
    target: str = "clicked"
    row_id: str = "impression_id"
    compat: bool = False
    create_basic: bool = True
    create_advanced: bool = True
    apply_selection: bool = True
    high_card_columns: Sequence[str] | None = ("user_id", "ad_id")
    hashed_columns: Sequence[str] | None = None
    n_folds: int = encoders.N_FOLDS
    seed: int = encoders.SEED
    remove_low_variance: bool = True
    remove_correlated: bool = True
    by_importance: bool = False
    n_features: int | None = None
    hot_rows: int | None = None


@dataclass
class FeatureState:
    """What fitting learned. `tables` are per-key lookups; `kept` is None without selection."""

    options: FeatureOptions
    tables: dict[str, DataFrame]
    keys: list[str] = field(default_factory=list)
    encoded: list[str] = field(default_factory=list)
    hashed: list[str] = field(default_factory=list)
    rates: list[str] = field(default_factory=list)
    kept: list[str] | None = None
    dropped: dict[str, str] = field(default_factory=dict)

    def save(self, path: str) -> None:
        for name, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")
        spark = next(iter(self.tables.values())).sparkSession
        manifest = {
            "options": asdict(self.options),
            "tables": sorted(self.tables),
            **{n: getattr(self, n) for n in ("keys", "encoded", "hashed", "rates", "kept", "dropped")},
        }
        one = spark.createDataFrame([(json.dumps(manifest),)], "value string")
        one.coalesce(1).write.mode("overwrite").text(f"{path}/manifest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureState:
        manifest = json.loads(spark.read.text(f"{path}/manifest").first()["value"])
        tables = {n: spark.read.parquet(f"{path}/{n}") for n in manifest.pop("tables")}
        return FeatureState(FeatureOptions(**manifest.pop("options")), tables, **manifest)


def fused_keys(df: DataFrame, options: FeatureOptions) -> list[str]:
    """Keys whose encodings come out of the shuffle that computes their history."""
    if not (options.create_basic and options.create_advanced) or TS not in df.columns:
        return []
    return [c for c in options.high_card_columns or () if c in KEYS and c in df.columns]


def basic_features(df: DataFrame, options: FeatureOptions = FeatureOptions()) -> DataFrame:
    """Temporal, key history, timeline and interaction features; steps without input are skipped."""
    source, columns = df, set(df.columns)
    if TS in columns:
        keys = [k for k in KEYS if k in columns]
        hot = hot_values(df, keys, options.hot_rows)

        def add(out: DataFrame, key: str) -> DataFrame:
            suffix, activity, overall = KEYS[key]
            return history.key_features(
                out, key, suffix, activity, overall, timeline=key == "user_id", compat=options.compat,
                encode=key in fused_keys(source, options), target=options.target, row_id=options.row_id,
                n_folds=options.n_folds, seed=options.seed, hot_rows=options.hot_rows, hot=hot[key], source=source,
            )

        df = history.heavy_first(df, keys, hot, add)
        # Columns of the row itself come last, so that no shuffle carries them.
        df = temporal_features(df)
    if {"device", "placement"} <= columns:
        df = interaction_key(df)
    if options.compat:
        rates = {n: c for n, c in PAIR_RATES.items() if set(c) <= columns}
        filled = [n for n in FILL_GLOBAL if n in rates]
        df = history.group_means(df, rates, options.target, filled, source)
    return df


def _key_totals(df: DataFrame, key: str, target: str) -> DataFrame:
    """What the log knows of each key value at its end."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.sum(target).alias("_clicks"),
            F.count(target).alias("_known"),
            F.max(TS).alias("_seen"),
            F.max(F.when(F.col(target) == 1, F.col(TS))).alias("_click"),
        )
    )


def _rate_table(df: DataFrame, keys: Sequence[str], name: str, target: str) -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.avg(target).alias(name))


def fit_transform(df: DataFrame, options: FeatureOptions = FeatureOptions()) -> tuple[DataFrame, FeatureState]:
    """The feature table of a labelled log, and the state to apply to later rows.

    Without automatic key detection and selection nothing runs until the result is used.
    """
    tables = {"global_mean": history.global_mean(df, options.target)}
    state = FeatureState(options, tables)
    out = df
    if options.create_basic:
        out = basic_features(out, options)
        for key in KEYS:
            if key in df.columns and TS in df.columns:
                tables[f"key_{key}"] = _key_totals(df, key, options.target)
                state.keys.append(key)
        if options.compat:
            for name, keys in PAIR_RATES.items():
                if set(keys) <= set(df.columns):
                    tables[f"rate_{name}"] = _rate_table(df, keys, name, options.target)
                    state.rates.append(name)
    if options.create_advanced:
        out, states = encoders.encode_all(
            out, options.high_card_columns, options.hashed_columns, options.target, options.row_id,
            options.n_folds, options.seed, source=df, done=fused_keys(df, options),
        )
        for key_state in states:
            tables[f"enc_{key_state.column}"] = key_state.table
            state.encoded.append(key_state.column)
            if key_state.hashed:
                state.hashed.append(key_state.column)
    if options.apply_selection:
        # Every step of the selection reads the features again.
        out = materialise(out, "features")
        chosen = select_features(
            out, options.target, (options.row_id,), options.remove_low_variance, options.remove_correlated,
            options.by_importance, options.n_features,
        )
        state.kept, state.dropped = chosen.kept, chosen.dropped
        out = chosen.apply(out)
    return out, state


def _apply_key(df: DataFrame, state: FeatureState, key: str) -> DataFrame:
    """History features of a row that comes after the fitted log."""
    suffix, activity, overall = KEYS[key]
    ts, compat = F.col(TS), state.options.compat
    # Saved tables have a known size, from which Spark chooses the join.
    joined = df.join(state.tables[f"key_{key}"], key, "left")
    mean = state.tables["global_mean"].select("_global_mean").scalar()
    rate = F.try_divide("_clicks", "_known")
    rows = F.coalesce("_rows", F.lit(0))
    columns = {
        f"ctr_{key}{suffix}": F.coalesce(rate, mean),
        f"impressions_{key}{suffix}": rows,
    }
    if activity:
        columns[activity] = rows
    if compat:
        columns[overall] = F.coalesce(rate, mean)
    if key == "user_id":
        never = F.lit(float(SECONDS_NEVER))
        since_click = F.coalesce(seconds_between(F.col("_click"), ts), never)
        columns["time_since_last_impression"] = F.coalesce(seconds_between(F.col("_seen"), ts), F.lit(0.0))
        columns["time_since_last_click" if compat else "time_since_click_safe"] = since_click
    return joined.select(*df.columns, *[c.alias(n) for n, c in columns.items()])


def transform(df: DataFrame, state: FeatureState, select: bool = True) -> DataFrame:
    """Features of new rows from the stored state alone; no statistics are taken from `df`.

    The label is not needed. Keys the log did not know get the defaults of the fit. The fitted
    selection is replayed unless `select` is false.
    """
    options = state.options
    out = df
    if options.create_basic:
        if TS in df.columns:
            out = temporal_features(out)
        for key in state.keys:
            out = _apply_key(out, state, key)
        if {"device", "placement"} <= set(df.columns):
            out = interaction_key(out)
        for name in state.rates:
            joined = out.join(state.tables[f"rate_{name}"], list(PAIR_RATES[name]), "left")
            mean = state.tables["global_mean"].select("_global_mean").scalar()
            out = joined.select(*out.columns, F.coalesce(F.col(name), mean).alias(name))
    for column in state.encoded:
        key_state = encoders.KeyState(
            column, state.tables[f"enc_{column}"], state.tables["global_mean"], column in state.hashed
        )
        if column in out.columns:
            out = encoders.encode_fitted(out, key_state, options.row_id, options.n_folds, options.seed, False)
    return out if state.kept is None or not select else Selection(state.kept, state.dropped).apply(out)


def create_features(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    options: FeatureOptions = FeatureOptions(),
    sample_frac: float | None = None,
    state_path: str | None = None,
) -> FeatureState:
    """Read a log, build its features, write them (and the state, if a path is given)."""
    from adlens.operators.sampling import stratified_sample
    from adlens.sources.tables import read_table, write_features

    df = read_table(spark, input_path)
    if options.row_id not in df.columns:
        df = materialise(with_row_id(df, options.row_id), "rows")
    if sample_frac is not None:
        df = stratified_sample(df, sample_frac, (options.target,), options.row_id, options.seed)
    features, state = fit_transform(df, options)
    write_features(features, output_path)
    if state_path:
        state.save(state_path)
    return state


def with_row_id(df: DataFrame, name: str = "impression_id") -> DataFrame:
    """A unique id: digest of the row, input partition, and number of the copy within it.

    Copies of one row are numbered per input partition, so a row repeated without end still
    spreads over all tasks. Write the result before using it twice: another reading of the input
    may cut it in other partitions.
    """
    digest = F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).cast("binary"))
    marked = df.withColumns({"_digest": digest, "_part": F.spark_partition_id()})
    copies = W.partitionBy("_digest", "_part").orderBy("_digest")
    numbered = marked.withColumn("_copy", F.row_number().over(copies))
    row_id = F.concat_ws("-", "_digest", F.col("_part").cast("string"), F.col("_copy").cast("string"))
    return numbered.select(*df.columns, row_id.alias(name))
