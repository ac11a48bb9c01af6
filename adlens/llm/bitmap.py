"""A bitmap of fixed size that tells which rows need not be shuffled.

The bits of the hashed keys of some table are joined to a second table by broadcast: a row whose bit is
not set surely has no partner there. A set bit is only a hint, so the caller joins those rows exactly.
The broadcast side is at most 4,096 bitmaps of 4 KB (16 MB), however many keys there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 27


def _bit(keys: list[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BITS)) + 1


def bitmap_of(df: DataFrame, keys: list[Column]) -> DataFrame:
    """One row per 32,768 bits: `_bucket`, `_bits`."""
    bit = _bit(keys)
    return df.groupBy(F.bitmap_bucket_number(bit).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bits")
    )


def with_hint(df: DataFrame, keys: list[Column], bitmap: DataFrame, name: str) -> DataFrame:
    """`df` with a boolean column: false where no key of the bitmap's table can be equal."""
    at = F.bitmap_bit_position(F.col("_bit"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (
        df.withColumn("_bit", _bit(keys))
        .withColumn("_bucket", F.bitmap_bucket_number(F.col("_bit")))
        .join(F.broadcast(bitmap), "_bucket", "left")
        .withColumn(name, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)))
        .drop("_bit", "_bucket", "_bits")
    )


def text_digest(text: Column) -> Column:
    """128 bits of a text, null read as empty: what tells rows apart whose ids are equal or missing."""
    return F.md5(F.encode(F.coalesce(text.cast("string"), F.lit("")), "UTF-8"))


def without_texts(docs: DataFrame, dropped: DataFrame, text_col: str, id_col: str | None = None) -> DataFrame:
    """Rows of `docs` whose text digest - with `id_col`, whose id and digest - is not among the rows of `dropped`.

    `dropped` has `digest` and, with `id_col`, `id`; a null id equals a null id. Only possible matches are shuffled.
    """
    keys = ["digest", "id"] if id_col else ["digest"]
    gone = dropped.select(*[F.col(k).alias(f"_gone_{k}") for k in keys]).distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    keyed = packed.withColumn("_digest", text_digest(F.col(f"_row.`{text_col}`")))
    hinted = with_hint(keyed, [F.col("_digest")], bitmap_of(gone, [F.col("_gone_digest")]), "_hint")
    same = F.col("_digest") == F.col("_gone_digest")
    if id_col:
        same &= F.col(f"_row.`{id_col}`").cast("long").eqNullSafe(F.col("_gone_id"))
    rest = hinted.filter("_hint").join(gone, same, "left_anti")
    return hinted.filter("NOT _hint").select("_row.*").unionByName(rest.select("_row.*"))
