"""Documents to packed training sequences, one operator of adlens.llm a stage.

Each stage is written to the shared folder of the cluster and read again, so a lost executor costs at most
the stage at hand. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm import decontaminate, exact_dedup, packing, quality, simhash
from adlens.llm.bitmap import without_texts
from adlens.llm.queries import QUALITY_LEAST, quality_model, tokenizer_path
from adlens.sources.materialise import materialise


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it is trained on these documents."""
    rows = quality.score_quality(docs, quality_model(spark, docs, sf_dir))
    return rows.filter(F.col("score") >= QUALITY_LEAST).select("_row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; rows without an id come last.

    Rows are told apart by id and text, so two texts under one id, or without one, are judged each by itself.
    """
    found = materialise(simhash.near_duplicates(docs), "near_copies")
    return without_texts(docs, materialise(simhash.surplus(found), "surplus"), "text", "doc_id")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; judged by their text, whatever their id."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = decontaminate.contamination(docs, items, with_digest=True).filter("n_hit > 0")
    return without_texts(docs, materialise(hits.select("digest"), "contaminated"), "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, as `op3_packing` returns them."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("packing", pack),
]

#: Trees, fingerprints and token ids have no SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
