"""Stable hash buckets that any engine with md5 can reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_mod(text: Column, n: int) -> Column:
    """The 128-bit md5 of `text`, read as one unsigned number, modulo `n` (n below 2**31).

    The hex digest is cut in pieces of 60, 60 and 8 bits, so every product fits a bigint.
    """
    if not 0 < n < 2**31:
        raise ValueError("n must be in 1 .. 2**31 - 1")
    digest = F.md5(text.cast("binary"))

    def piece(start: int, length: int) -> Column:
        return F.conv(F.substring(digest, start, length), 16, 10).cast("bigint")

    high = (piece(1, 15) % n) * (2**68 % n)
    middle = (piece(16, 15) % n) * (2**8 % n)
    return ((high + middle + piece(31, 2)) % n).cast("int")


def hash_bucket(text: Column, n: int) -> Column:
    """A bucket in 0 .. n-1 from the first 60 bits of the md5; cheaper than the whole of it."""
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint") % n).cast("int")


def hash_rank(row_id: Column, seed: int = 42) -> Column:
    """Pseudo-random order key of a row: 32 hex digits, uniform and reproducible."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")).cast("binary"))
