"""Ids above 2**53 beside ids that are null: no operator may turn them into floating-point numbers."""

from __future__ import annotations

import pytest

import corpus_pipeline
from adlens.llm import decontaminate, packing, queries, simhash

BIG = [2**60 + 1, 2**60 + 3]
TEXT = "one two three four five six seven eight nine ten"


@pytest.fixture
def docs(spark):
    rows = [(BIG[0], TEXT), (None, "something else entirely"), (BIG[1], f"a {TEXT} b"), (None, TEXT)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def test_packing_in_one_group(docs):
    got = packing.pack(docs, queries.tokenizer_path(), group_bytes=1 << 30).collect()
    assert {r.doc_id for r in got} == {None, *BIG}
    for i, r in ((r.doc_id, r) for r in got if r.start == 0):
        assert r.doc_tokens == {BIG[0]: 11, BIG[1]: 13}.get(i, r.doc_tokens)


def test_decontamination_with_large_and_null_item_ids(spark, docs):
    items = spark.createDataFrame([(BIG[1], TEXT), (None, TEXT), (BIG[0], "nothing of this kind")], "item_id long, text string")
    got = {r.id: r for r in decontaminate.contamination(docs, items).collect()}
    assert set(got) == {None, *BIG}
    for i in BIG:
        assert set(got[i]["items"]) == {BIG[1], None} and got[i].n_hit == 10


def test_near_duplicates(docs):
    got = simhash.near_duplicates(docs).collect()
    assert sorted(str(r.id) for r in got) == sorted(map(str, [None, None, *BIG]))
    assert {r.component_id for r in got if r.id == BIG[0]} == {BIG[0]}


def test_copies_of_a_row_are_dealt_to_many_groups(spark):
    docs = spark.range(2000, numPartitions=8).selectExpr("CAST(7 AS BIGINT) AS doc_id", "repeat('word ', 100) AS text")
    got = packing.pack(docs, queries.tokenizer_path(), group_bytes=100_000)
    assert got.selectExpr("sequence_id div 16777216 AS g").distinct().count() == 10


LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def kept(spark, stage, rows, sf_dir=None):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS).repartition(3)
    out = STAGES[stage](spark, docs, sf_dir)
    assert out.dtypes == docs.dtypes
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_near_copies_without_ids_and_under_one_id(spark):
    """A mark more or less leaves the shingles of a text alone; A-Z and a-z are one."""
    one, two, three = LONG, LONG.upper(), LONG.title()
    assert kept(spark, "simhash_near_dedup", [(BIG[1], one), (None, two), (BIG[0], three)]) == [(BIG[0], three)]
    nameless = kept(spark, "simhash_near_dedup", [(None, one), (None, two), (None, "other words here"), (4, "far away")])
    assert len(nameless) == 3 and {t for _, t in nameless} >= {"other words here", "far away"}
    shared = kept(spark, "simhash_near_dedup", [(7, one), (7, two), (7, "a text of its own")])
    assert len(shared) == 2 and (7, "a text of its own") in shared
    assert kept(spark, "simhash_near_dedup", []) == []


def test_benchmark_passages_without_ids_and_under_one_id(spark, tmp_path):
    spark.createDataFrame([(1, LONG)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, f"x {LONG} y"), (5, f"{LONG} z"), (5, "clean"), (None, "clean too"), (6, None), (BIG[0], "clean")]
    want = sorted([(5, "clean"), (None, "clean too"), (6, None), (BIG[0], "clean")], key=str)
    assert kept(spark, "benchmark_decontamination", rows, str(tmp_path)) == want
