"""Connected components of links between 64-bit nodes, by alternating star contractions.

Each round links the larger neighbours of a node to its smallest one, then the smaller ones. Only minima
are gathered per node, so a node with very many links is an aggregate and a join that can be split.
Every round is written to the shared folder: the plan stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.sources.materialise import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a")
    return (
        linked.filter("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """`a`, `root` (the smallest node of its component) for every linked node but the roots themselves."""
    now = materialise(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select("a", F.col("b").alias("root"))
        seen = mark
        now = materialise(_small_star(_large_star(now)), "links")
