"""Heavy keys from mergeable summaries, without counting all keys.

Each task keeps a Misra-Gries summary of bounded size for every key asked about: whoever makes up more than one part in
`slots` of the task's rows is in it, counted too low by at most that share. A task sends only entries above the same
share, so what is shuffled are few pairs of a hash and a number, whatever the number of keys; their sums are too low by
at most 2 / slots of all rows. With `slots` = 4 x rows / limit every key over the limit has a sum over half of it, and
no more than 2 x rows / limit keys do. Only these are then counted exactly; there is no other limit on their number.
A table with no more rows than the limit has no heavy key, and is not read beyond counting its rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOUND = "which int, hash long, low long"


class Summary:
    """Misra-Gries over 64-bit hashes: at most `slots` counters after each batch."""

    def __init__(self, slots: int) -> None:
        self.slots = slots
        self.rows = 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, hashes: np.ndarray) -> None:
        self.rows += len(hashes)
        keys, counts = np.unique(hashes, return_counts=True)
        keys, at = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([self.counts, counts]), len(keys)).astype(np.int64)
        if len(keys) > self.slots:
            # What all lose is the largest count that does not fit; no key loses more than rows / slots in all.
            counts -= np.partition(counts, len(counts) - self.slots - 1)[len(counts) - self.slots - 1]
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts

    def heavy(self) -> tuple[np.ndarray, np.ndarray]:
        enough = self.counts * self.slots >= self.rows
        return self.keys[enough], self.counts[enough]


def heavy_hashes(df: DataFrame, keys: Sequence[Sequence[str]], rows: int, limit: int) -> DataFrame:
    """(`which`, `hash`): hashes of all keys with over `limit` of the `rows` rows, for each of the key lists, and of
    some with over half as many. Rows with a null in a key do not count for it."""
    slots = ceil(4 * rows / max(limit, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Summary(slots) for _ in keys]
        for batch in batches:
            for summary, column in zip(own, batch.columns, strict=True):
                summary.add(column.drop_null().to_numpy())
        for which, summary in enumerate(own):
            hashes, counts = summary.heavy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(hashes), which, np.int32)), pa.array(hashes), pa.array(counts)], ["which", "hash", "low"]
            )

    return (
        df.select(*[_hash(k).alias(f"h{i}") for i, k in enumerate(keys)])
        .mapInArrow(run, FOUND)
        .groupBy("which", "hash")
        .agg(F.sum("low").alias("low"))
        .filter(F.col("low") * 2 > limit)
        .select("which", "hash")
    )


def _hash(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return F.when(known, F.xxhash64(*keys))


def heavy_keys(df: DataFrame, keys: Sequence[Sequence[str]], limit: int) -> list[list]:
    """For each key list the keys with over `limit` rows, heaviest first, as rows of the key columns and `_rows`."""
    rows = df.select(*dict.fromkeys(k for own in keys for k in own)).count()
    if rows <= limit:
        return [[] for _ in keys]
    # Size bound: 2 x rows / limit hashes for each key list.
    found = heavy_hashes(df, keys, rows, limit).collect()
    out = []
    for i, own in enumerate(keys):
        hashes = [(r["hash"],) for r in found if r["which"] == i]
        if not hashes:
            out.append([])
            continue
        some = F.broadcast(df.sparkSession.createDataFrame(hashes, "_hash long"))
        counted = (
            df.select(*own, _hash(own).alias("_hash"))
            .join(some, "_hash", "left_semi")
            .groupBy(*own)
            .agg(F.count(F.lit(1)).alias("_rows"))
            .filter(F.col("_rows") > limit)
        )
        out.append(counted.orderBy(F.desc("_rows"), *own).collect())
    return out
