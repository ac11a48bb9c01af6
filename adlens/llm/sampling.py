"""A bounded training sample of labelled documents, and how a model gets from one task to all."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.sources.materialise import materialise

CELLS = 1 << 30


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves `part`; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, train: Column, per_label: int) -> DataFrame:
    """`_id`, `label`, `weight`: about `per_label` ids for each label, chosen by a hash of the id.

    `weight` undoes the different fractions. Ids with null labels are left out, repeated ids count once.
    """
    known = (
        labels.filter(train & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).cast("long").alias("_id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    fraction = {k: min(1.0, per_label / n) for k, n in counts.items()}
    cell = F.pmod(F.xxhash64("_id"), F.lit(CELLS))
    chosen = F.lit(False)
    weight = F.lit(1.0)
    for k, f in fraction.items():
        chosen = chosen | ((F.col("label") == k) & (cell < int(f * CELLS)))
        weight = F.when(F.col("label") == k, F.lit(1.0 / f)).otherwise(weight)
    return known.filter(chosen).withColumn("weight", weight)


def fit_in_one_task(features: DataFrame, order: list[str], fit: Callable[[pd.DataFrame], object]) -> object:
    """Run `fit` on a bounded table in one task and return what it makes.

    The table is written first: reading all documents to find and measure the sample is the work of all tasks, and
    only the sample itself goes through one.
    """
    sample = materialise(features, "sample")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = list(frames)
        if own:
            frame = pd.concat(own, ignore_index=True).sort_values(order, kind="stable")
            yield pd.DataFrame({"model": [pickle.dumps(fit(frame.reset_index(drop=True)))]})

    rows = sample.coalesce(1).mapInPandas(run, "model binary").collect()
    return pickle.loads(bytes(rows[0]["model"])) if rows else None
