"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

The first scan keeps 16 bytes a row (length and the hash of a short prefix). Lengths that occur once are
out, then prefixes that occur once within a length. What is left is noted in a bitmap of fixed size, and
the second scan hashes whole texts only where the bitmap says so. Rows that are out are never shuffled.
A group of any size is one counted row before it meets its members, and that join can be split.

Defined cases: a null text equals an empty one; of equal texts the row with the largest id stays; null
ids never win over others; rows that repeat both id and text are one document and all marked as kept
(`keep_one` leaves one of them). An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.bitmap import bitmap_of, with_hint
from adlens.sources.materialise import materialise

PREFIX_CHARS = 64


def _measured(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int) -> DataFrame:
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    body = F.coalesce(F.col(f"_row.`{text_col}`"), F.lit(""))
    return packed.select(
        "_row",
        F.col(f"_row.`{id_col}`").alias("_id"),
        body.alias("_body"),
        F.octet_length(body).alias("_len"),
        F.xxhash64(F.substring(body, 1, prefix_chars)).alias("_prefix"),
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    digest_all: bool = False,
) -> DataFrame:
    """A row for each row of `docs`: `_row` (all its columns), `_id`, `text_sha256`, `keep_id`, `group_size`, `kept`.

    `text_sha256` is null for rows that length or prefix settled, unless `digest_all` asks for it.
    """
    rows = _measured(docs, id_col, text_col, prefix_chars)
    keys = materialise(rows.select("_len", "_prefix"), "lengths")
    lengths = keys.groupBy("_len").count().filter("count > 1").select("_len")
    prefixes = (
        keys.join(lengths, "_len", "left_semi").groupBy("_len", "_prefix").count().filter("count > 1")
    )
    bits = materialise(bitmap_of(prefixes, [F.col("_len"), F.col("_prefix")]), "prefixes")
    hinted = with_hint(rows, [F.col("_len"), F.col("_prefix")], bits, "_hint")
    digest = F.sha2(F.encode(F.col("_body"), "UTF-8"), 256)

    alone = hinted.filter("NOT _hint").select(
        "_row",
        "_id",
        (digest if digest_all else F.lit(None).cast("string")).alias("text_sha256"),
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    hashed = hinted.filter("_hint").withColumn("text_sha256", digest)
    groups = hashed.groupBy("_len", "text_sha256").agg(
        F.max("_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    together = hashed.join(groups, ["_len", "text_sha256"]).select(
        "_row",
        "_id",
        "text_sha256",
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
    )
    return alone.unionByName(together)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of `docs`, one row of each group of equal texts."""
    rows = exact_groups(docs, id_col, text_col).filter("kept")
    alone = rows.filter("group_size = 1").select("_row.*")
    first = rows.filter("group_size > 1").dropDuplicates(["text_sha256"])
    return alone.unionByName(first.select("_row.*"))
