"""Joining a table of per-key values to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.sources.materialise import materialise

BROADCAST_KEYS = 100_000


def few_keys(df: DataFrame, key_lists: Sequence[Sequence[str]], limit: int = BROADCAST_KEYS) -> list[bool]:
    """Whether each list of key columns has at most about `limit` distinct values.

    One pass over the key columns with mergeable sketches, nothing is shuffled by key.
    """
    if not key_lists:
        return []
    sketches = [F.approx_count_distinct(F.xxhash64(*keys), 0.02).alias(f"k{i}") for i, keys in enumerate(key_lists)]
    return [n <= limit for n in df.agg(*sketches).first()]


def join_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Left join of one row per key.

    A lookup checked to be `small` is broadcast, so the rows stay where they are. Otherwise both
    sides are shuffled by key, and Spark splits the rows of a heavy key over several tasks.
    """
    return df.join(F.broadcast(lookup) if small else lookup, list(keys), "left")


def grouped_tables(df: DataFrame, groups: Mapping[str, Sequence[str]], aggregates: Mapping[str, Column]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The aggregates of every grouping by its name, and of all rows, from one scan and one shuffle.

    The result is written once: Spark knows the size of each table when it joins it, broadcasts the small ones and
    splits the rows of a heavy key over several tasks where it does not. A null key is a group like any other. The
    table of all rows is empty if there are no rows.
    """
    columns = list(dict.fromkeys(k for keys in groups.values() for k in keys))
    sets = list(dict.fromkeys(tuple(sorted(keys)) for keys in groups.values()))
    marks = [F.grouping(c).alias(f"_without_{c}") for c in columns]
    grouped = df.groupingSets([[F.col(c) for c in own] for own in [*sets, ()]], *columns)
    written = materialise(grouped.agg(*[a.alias(n) for n, a in aggregates.items()], *marks), "groupings")

    def part(keys: Sequence[str]) -> DataFrame:
        own = F.lit(True)
        for c in columns:
            own = own & (F.col(f"_without_{c}") == (0 if c in keys else 1))
        return written.filter(own).select(*keys, *aggregates)

    return {name: part(keys) for name, keys in groups.items()}, part(())
