"""History, group rates, encodings, samples, selection and the feature table."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from adlens.functions import hashing, temporal
from adlens.operators import encoders, history, normalize, sampling, selection
from adlens.plans import feature_table


def by_id(df, *columns):
    return {r["impression_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_history_uses_only_earlier_rows(log):
    got = by_id(history.history_features(log, "user_id", "_user"), "ctr_user_id_user", "impressions_user_id_user")
    mean = 5 / 8
    assert got[1] == (mean, 0) and got[2] == (0.0, 1) and got[3] == (0.5, 2) and got[5] == (0.5, 4)
    assert got[6] == (mean, 0)
    assert got[7] == (mean, None), "a missing key has no history"


def test_changing_later_rows_leaves_earlier_features_alone(log):
    names = ["ctr_user_id_user", "impressions_user_id_user", "time_since_last_impression", "time_since_click_safe", "clicked"]
    late = F.col("timestamp") >= F.lit("2024-01-01 00:00:30").cast("timestamp_ntz")
    changed = log.withColumn("clicked", F.when(late, 1 - F.col("clicked")).otherwise(F.col("clicked")))
    # The global mean legitimately moves; compare rows that have a history.
    a = by_id(history.key_features(log, "user_id", "_user", timeline=True), *names)
    b = by_id(history.key_features(changed, "user_id", "_user", timeline=True), *names)
    for i in (2, 3, 4):
        assert a[i] == b[i]


def test_own_label_does_not_leak(log):
    flipped = log.withColumn("clicked", F.when(F.col("impression_id") == 3, 0).otherwise(F.col("clicked")))
    safe = by_id(history.user_timeline(log), "time_since_click_safe")
    assert safe[3] == by_id(history.user_timeline(flipped), "time_since_click_safe")[3]
    leaky = by_id(history.user_timeline(log), "time_since_last_click")
    assert leaky[3] != by_id(history.user_timeline(flipped), "time_since_last_click")[3]


def test_timeline(log):
    got = by_id(history.user_timeline(log), "time_since_last_impression", "time_since_last_click", "time_since_click_safe")
    never = float(temporal.SECONDS_NEVER)
    assert got[1] == (0.0, never, never)
    assert got[2] == (10.0, 0.0, never)
    assert got[3] == (0.0, 0.0, 0.0)
    assert got[4] == (0.0, never, 0.0)
    assert got[5] == (50.5, 50.5, 50.5)
    assert got[7] == (0.0, 0.0, never)


def test_merge_on_time_repeats_rows(log):
    merged = history.click_gap_merge(log)
    # Two clicks of u1 at :10 meet three rows of that time.
    assert merged.filter("user_id = 'u1'").count() == 5 + 3
    assert history.user_timeline(log).count() == log.count()


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_key_features_on_the_hot_path(impressions, hot_rows):
    plain = history.key_features(impressions, "device", "_device", "n", "rate", True, True, True)
    split = history.key_features(impressions, "device", "_device", "n", "rate", True, True, True, hot_rows=hot_rows)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))


def test_group_means_match_pandas(impressions):
    pdf = impressions.toPandas()
    got = by_id(history.group_rates(impressions), *history.GROUP_RATES)
    for i, (name, keys) in enumerate(history.GROUP_RATES.items()):
        want = pdf.groupby(keys)["clicked"].transform("mean")
        assert np.allclose([got[k][i] for k in pdf["impression_id"]], want), name


def test_null_keys_get_the_fill_value(log):
    df = log.withColumns({"device": F.lit("mobile"), "placement": F.lit("footer"), "hour": F.lit(0)})
    got = by_id(history.group_rates(df), "user_ctr_overall", "user_device_ctr")
    assert got[7] == (None, 5 / 8)


# --- hashing and encodings --------------------------------------------------------------------


@pytest.mark.parametrize("n", [2, 10, 10_000, 2**31 - 1])
def test_md5_mod_equals_the_big_integer(spark, n):
    texts = ["", "a", "t1:42", "é", "nan"] + [str(i) for i in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", hashing.md5_mod(F.col("t"), n).alias("m"))
    for r in df.collect():
        assert r["m"] == int(hashlib.md5(r["t"].encode()).hexdigest(), 16) % n


def test_hash_features_mark_one_bucket(log):
    for r in encoders.hash_features(log, "user_id").collect():
        want = int(hashlib.md5((r["user_id"] or "nan").encode()).hexdigest(), 16) % 10
        assert [r[f"user_id_hash_{i}"] for i in range(10)] == [int(i == want) for i in range(10)]


def test_out_of_fold_encoding_equals_the_fold_loop(impressions):
    df = encoders.kfold_assign(impressions.withColumn("user_id", F.when(F.col("user_id") != 3, F.col("user_id"))))
    pdf = df.toPandas()
    pdf["want"] = np.nan
    for fold in range(5):
        rest = pdf[pdf.fold != fold].groupby("user_id")["clicked"].mean()
        pdf.loc[pdf.fold == fold, "want"] = pdf.loc[pdf.fold == fold, "user_id"].map(rest)
    pdf["want"] = pdf["want"].fillna(pdf["clicked"].mean())
    got = by_id(encoders.target_encode_oof(df, "user_id"), "user_id_target_enc")
    assert np.allclose([got[i][0] for i in pdf["impression_id"]], pdf["want"])
    fused = by_id(history.key_features(df, "user_id", "_user", encode=True), "user_id_target_enc")
    assert np.allclose([fused[i][0] for i in pdf["impression_id"]], pdf["want"])


def test_frequency_of_null_and_unseen_keys_is_zero(log):
    state = encoders.fit_frequency(log.filter("impression_id < 6"), "user_id")
    got = by_id(encoders.apply_frequency(log, state, "user_id"), "user_id_freq", "user_id_freq_norm")
    assert got[1] == (5, 1.0) and got[6] == (0, 0.0) and got[7] == (0, 0.0)


def test_a_key_seen_once_gets_the_global_mean(log):
    got = by_id(encoders.target_encode_oof(log, "user_id"), "user_id_target_enc")
    assert got[6] == (5 / 8,)


def test_detection_counts_exactly_near_the_limit(spark):
    df = spark.range(101).select(
        F.col("id"), F.col("id").cast("string").alias("s"), (F.col("id") % 100).alias("hundred"),
        F.col("id").cast("int").alias("narrow"), F.lit(1).alias("clicked"),
    )
    assert encoders.detect_high_cardinality(df) == {"id": 101, "s": 101}


# --- samples ----------------------------------------------------------------------------------


def test_split_is_exact_and_covers_every_row_once(impressions):
    parts = sampling.split_train_val_test(impressions).select("impression_id", "clicked", "split").toPandas()
    assert sorted(parts["impression_id"]) == sorted(impressions.toPandas()["impression_id"])
    for _, group in parts.groupby("clicked"):
        n, counts = len(group), group["split"].value_counts()
        assert counts["train"] == int(np.floor(n * 0.64 + 0.5)) and abs(counts["test"] - 0.2 * n) <= 1


def test_samples_are_exact_and_repeatable(impressions):
    a = sampling.stratified_sample(impressions, 0.25)
    sizes = {r["clicked"]: r["count"] for r in a.groupBy("clicked").count().collect()}
    for r in impressions.groupBy("clicked").count().collect():
        assert sizes[r["clicked"]] == int(np.floor(r["count"] * 0.25 + 0.5))
    again = sampling.stratified_sample(impressions.repartition(7), 0.25)
    assert sorted(map(str, a.collect())) == sorted(map(str, again.collect()))
    assert sampling.sample_n(impressions, 100).count() == 100
    assert sampling.sample_n(impressions, 10**6).count() == impressions.count()
    assert sampling.stratified_sample(impressions, 1.5).count() == impressions.count()


def test_null_strata_are_split_too(spark):
    df = spark.range(100).select(F.col("id").alias("impression_id"), F.when(F.col("id") < 40, 1).alias("clicked"))
    kept = sampling.stratified_sample(df, 0.5).groupBy("clicked").count().collect()
    assert {r["clicked"]: r["count"] for r in kept} == {1: 20, None: 30}


@pytest.mark.parametrize(("digits", "rank_rows"), [(1, 1), (1, 40), (2, 1), (3, 10**6)])
def test_boundaries_are_found_digit_by_digit(spark, monkeypatch, digits, rank_rows):
    monkeypatch.setattr(sampling, "DIGITS", digits)
    monkeypatch.setattr(sampling, "RANK_ROWS", rank_rows)
    ids = [*range(500), *range(10_000, 10_003)]
    df = spark.createDataFrame([(i, i % 2 if i < 500 else None) for i in ids], "impression_id long, clicked long").repartition(3)
    got = {r["impression_id"]: r["split"] for r in sampling.split_train_val_test(df).collect()}
    for stratum in (0, 1, None):
        own = [i for i in ids if (i % 2 if i < 500 else None) == stratum]
        own.sort(key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
        ends = [int(np.floor(len(own) * e + 0.5)) for e in (0.64, 0.8)]
        want = ["train"] * ends[0] + ["val"] * (ends[1] - ends[0]) + ["test"] * (len(own) - ends[1])
        assert [got[i] for i in own] == want
    assert sampling.sample_n(df, 0).count() == 0 and sampling.sample_n(df, 7).count() == 7
    assert sampling.sample_n(df, 503).count() == sampling.sample_n(df, 504).count() == 503
    assert sampling.sample_n(df.limit(0), 3).count() == 0


def test_rows_are_labelled_where_they_are(spark):
    df = spark.range(5000).select(F.col("id").alias("impression_id"), (F.col("id") % 2).alias("clicked"), F.lit("wide").alias("payload"))
    plan = sampling.split_train_val_test(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan  # only the table of bounds is grouped
    same = sampling.random_sample(df, 0.3, row_id="impression_id")
    assert sorted(r[0] for r in same.collect()) == sorted(r[0] for r in sampling.random_sample(df.repartition(9), 0.3, row_id="impression_id").collect())
    assert 1300 < same.count() < 1700


# --- selection --------------------------------------------------------------------------------


def test_variance_fills_gaps_like_the_fit_does(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1.0, 1.0, nan, 5.0, 0), (1.0, 2.0, inf, 5.0, 1), (1.0, inf, nan, 5.05, 0), (1.0, nan, nan, 5.1, 1)]
    df = spark.createDataFrame(rows, "constant double, gaps double, nothing double, close double, clicked int")
    got = {r["feature"]: (r["variance"], r["keep"]) for r in selection.variance_report(df).collect()}
    assert got["constant"] == (0.0, False) and got["nothing"] == (0.0, False)
    assert got["gaps"] == (pytest.approx(np.var([1, 2, 1e6, 1e6])), True)
    assert got["close"] == (pytest.approx(np.var([5, 5, 5.05, 5.1])), False)


def test_correlation_drops_every_column_with_an_earlier_partner(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=300)
    b, c = a + rng.normal(size=300) * 0.2, None
    c = b + rng.normal(size=300) * 0.2
    pdf = pd.DataFrame({"a": a, "b": b, "c": c, "flat": 1.0, "clicked": 0})
    corr = pdf[["a", "b", "c", "flat"]].corr().abs()
    want = [k for j, k in enumerate(corr.columns) if any(corr.iloc[i, j] > 0.95 for i in range(j))]
    assert sorted(selection.high_correlation_columns(spark.createDataFrame(pdf))) == sorted(want)


def test_correlation_over_pairs_with_both_values(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, np.nan, 5], "b": [2.0, np.nan, 7, 8, 1], "clicked": 0})
    got = selection.correlation_pairs(spark.createDataFrame(pdf)).first()["correlation"]
    assert got == pytest.approx(abs(pdf["a"].corr(pdf["b"])))


def test_selection_keeps_text_and_target(spark):
    df = spark.range(50).select(
        F.lit("x").alias("text"), F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("twice"),
        F.lit(1).alias("same"), (F.col("id") % 2).cast("int").alias("clicked"),
    )
    chosen = selection.select_features(df)
    assert chosen.kept == ["text", "a", "clicked"]
    assert chosen.dropped == {"same": "low variance", "twice": "correlated"}
    ranked = selection.select_features(df, remove_correlated=False, by_importance=True, n_features=1)
    assert len([c for c in ranked.kept if c in ("a", "twice")]) == 1


# --- feature table ----------------------------------------------------------------------------


def test_state_survives_saving_and_replays_the_selection(spark, impressions, tmp_path):
    options = feature_table.FeatureOptions(hashed_columns=("user_id",))
    built, state = feature_table.fit_transform(impressions, options)
    state.save(str(tmp_path / "state"))
    loaded = feature_table.FeatureState.load(spark, str(tmp_path / "state"))
    assert loaded.kept == state.kept and loaded.dropped == state.dropped
    new = impressions.drop("clicked").withColumn("user_id", F.when(F.col("impression_id") < 900, F.col("user_id")).otherwise(-1))
    a = sorted(map(str, feature_table.transform(new, loaded).collect()))
    assert a == sorted(map(str, feature_table.transform(new, state).collect()))
    assert set(feature_table.transform(new, loaded).columns) == set(built.columns) - {"clicked"}


def test_transform_gives_the_fitted_frequencies(impressions):
    options = feature_table.FeatureOptions(apply_selection=False)
    built, state = feature_table.fit_transform(impressions, options)
    again = feature_table.transform(impressions.drop("clicked"), state)
    names = ["user_id_freq", "user_id_freq_norm", "user_activity_level", "month", "time_of_day", "device_placement"]
    assert by_id(built, *names) == by_id(again, *names)


def test_features_do_not_depend_on_the_hot_path(impressions):
    names = None
    results = []
    for hot_rows in (None, 60):
        options = feature_table.FeatureOptions(apply_selection=False, hashed_columns=(), hot_rows=hot_rows)
        built, _ = feature_table.fit_transform(impressions, options)
        names = names or [c for c in built.columns if c != "impression_id"]
        results.append(by_id(built, *names))
    assert results[0] == results[1]


def test_steps_without_their_column_are_skipped(impressions):
    built, _ = feature_table.fit_transform(
        impressions.drop("ad_id", "placement"), feature_table.FeatureOptions(apply_selection=False, high_card_columns=("user_id",), hashed_columns=())
    )
    assert "ctr_user_id_user" in built.columns and "ctr_ad_id_ad" not in built.columns


def test_row_ids_are_unique(spark):
    df = spark.createDataFrame([("a", 1)] * 50 + [("b", None)], "x string, y int").repartition(3)
    assert feature_table.with_row_id(df, "id").select("id").distinct().count() == 51


# --- normalisation ----------------------------------------------------------------------------


def test_log_hours(spark):
    hours = {"14102100": "2014-10-21 00:00:00", "5010112": "2005-01-01 12:00:00", "70010105": "1970-01-01 05:00:00",
             "24139901": None, "bad": None, None: None, "2024010112": None}
    df = spark.createDataFrame([(h,) for h in hours], "hour string")
    for r in normalize.normalise_hour(df.withColumn("raw", F.col("hour"))).collect():
        assert (str(r["timestamp"]) if r["timestamp"] else None) == hours[r["raw"]]
        if r["timestamp"] is None:
            assert r["is_weekend"] == 0 and r["hour"] is None


def test_codes_and_keys(spark):
    df = spark.createDataFrame([(1, 7, "d", None), (None, None, None, "i"), (9, 5, "d", "i")],
                               "device_type int, banner_pos int, device_id string, device_ip string")
    got = normalize.normalise_log(df.withColumns({"C1": F.lit(3), "C14": F.lit(15)}))
    assert [(r["device"], r["placement"], r["user_id"], r["ad_id"]) for r in got.collect()] == [
        ("desktop", "footer", "d_nan", "15"), ("other", "other", "nan_i", "15"), ("other", "header", "d_i", "15"),
    ]
    assert normalize.pick_ad_id(df.withColumn("C1", F.lit(3))).first()["ad_id"] == "3"


@pytest.mark.parametrize("hour,part,business", [(0, "night", 0), (6, "night", 0), (7, "morning", 0), (9, "morning", 1), (12, "morning", 1),
                                                (13, "afternoon", 1), (17, "afternoon", 1), (18, "afternoon", 0), (19, "evening", 0)])
def test_parts_of_the_day(spark, hour, part, business):
    h = F.lit(hour)
    assert tuple(spark.range(1).select(temporal.time_of_day(h), temporal.business_hours(h)).first()) == (part, business)


def test_all_keys_are_fitted_by_one_scan(spark, tmp_path):
    """One scan and one shuffle make the written table; what is joined to the rows is read from that."""
    rows = [(i, f"u{i % 40}" if i % 9 else None, i % 7, "x" if i % 2 else "y", i % 3 % 2) for i in range(400)]
    spark.createDataFrame(rows, "impression_id long, user_id string, ad_id int, device string, clicked int").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    out, states = encoders.encode_all(df, ["user_id", "ad_id", "device"])
    assert [s.hashed for s in states] == [False] * 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in plan.split("\n") if "FileScan" in line and "impression_id" in line]) == 1
    got = {r["impression_id"]: r for r in out.collect()}
    mean = sum(r[4] for r in rows) / len(rows)
    fold = {r["impression_id"]: r["fold"] for r in encoders.kfold_assign(df).collect()}
    for i, *keys, _ in rows:
        for at, name in enumerate(("user_id", "ad_id", "device")):
            same = [r for r in rows if r[1 + at] == keys[at] and keys[at] is not None]
            others = [r[4] for r in same if fold[r[0]] != fold[i]]
            assert got[i][f"{name}_freq"] == len(same)
            assert got[i][f"{name}_target_enc"] == pytest.approx(sum(others) / len(others) if others else mean)


def test_groupings_of_an_empty_table(spark):
    df = spark.createDataFrame([], "impression_id long, user_id string, clicked int")
    out, states = encoders.encode_all(df, ["user_id"])
    assert out.count() == 0 and states[0].global_mean.first()[0] is None
    more = spark.createDataFrame([(1, "u", 1)], df.schema)
    assert encoders.encode_fitted(more, states[0], out_of_fold=False).first()["user_id_target_enc"] is None
