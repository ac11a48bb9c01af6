"""Exact samples and splits without sorting, or even shuffling, the table.

A row's place in its stratum is decided by the md5 of its id. Where a label ends is found by radix selection: rows are
counted by the leading digits of their hash, the cell that holds the boundary is the only one whose rows are counted by
further digits, and so on until it is small; then the ids in it are ranked. What is left of it is one (hash, id) per
stratum and boundary, and each row is labelled where it is, by comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlens.functions.hashing import hash_rank
from adlens.sources.materialise import materialise

ROW_ID = "impression_id"
#: Hexadecimal digits by which a round refines, of those that a hash has, and the rows that are few enough to rank.
DIGITS, HASH_DIGITS = 3, 32
RANK_ROWS = 50_000


def boundary_rows(
    hashed: DataFrame, strata: Sequence[str], bounds: Callable[[Column], Sequence[Column]], digits: int, rank_rows: int
) -> DataFrame:
    """(strata, `_j`, `_at`): the row, as a struct of hash and id, whose rank in its stratum is the `_j`-th bound.

    `hashed` has the strata, `_hash` and `_id`. A bound beyond the last row of a stratum has no row.
    """
    strata = list(strata)

    def picked(cells: DataFrame, per: Sequence[str], bound: Column) -> DataFrame:
        """The cells that hold a bound, with the bound counted from the cell's first row."""
        before = W.partitionBy(*per).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
        placed = cells.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        inside = (bound >= F.col("_start")) & (bound < F.col("_start") + F.col("_n"))
        return placed.filter(inside).select(*strata, "_j", "_cell", (bound - F.col("_start")).alias("_offset"), "_n")

    length = digits
    cells = hashed.groupBy(*strata, F.substring("_hash", 1, length).alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(W.partitionBy(*strata))
    ends = bounds(F.col("_total"))
    ranks = F.array(*[F.struct(F.lit(j).alias("_j"), F.greatest(e, F.lit(0)).cast("long").alias("_b")) for j, e in enumerate(ends)])
    listed = cells.withColumn("_total", total).select(*strata, "_cell", "_n", F.inline(ranks))
    # Size bound: one row for each stratum and bound, from at most 16 ** digits cells of each.
    active = materialise(picked(listed, [*strata, "_j"], F.col("_b")), "boundaries")
    while length < HASH_DIGITS and (active.agg(F.max("_n")).first()[0] or 0) > rank_rows:
        finer = min(length + digits, HASH_DIGITS)
        inside = _in_cells(hashed, active, strata, length)
        cells = inside.groupBy(*strata, "_j", "_offset", F.substring("_hash", 1, finer).alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
        active = materialise(picked(cells, [*strata, "_j"], F.col("_offset")), "boundaries")
        length = finer
    place = F.row_number().over(W.partitionBy(*strata, "_j").orderBy("_hash", "_id")) - 1
    ranked = _in_cells(hashed, active, strata, length).withColumn("_place", place)
    return ranked.filter(F.col("_place") == F.col("_offset")).select(*strata, "_j", F.struct("_hash", "_id").alias("_at"))


def _in_cells(hashed: DataFrame, active: DataFrame, strata: Sequence[str], length: int) -> DataFrame:
    """Rows of `hashed` in the cells that hold a bound, once for each bound of the cell."""
    own = active.select(*[F.col(s).alias(f"_of_{s}") for s in strata], "_j", "_offset", F.col("_cell").alias("_of_cell"))
    match = F.substring("_hash", 1, length) == F.col("_of_cell")
    for s in strata:
        match &= F.col(s).eqNullSafe(F.col(f"_of_{s}"))
    return hashed.join(own, match).select(*hashed.columns, "_j", "_offset")


def label_by_rank(
    df: DataFrame,
    strata: Sequence[str],
    row_id: str,
    labels: Sequence[str],
    bounds: Callable[[Column], Sequence[Column]],
    seed: int,
    name: str,
    digits: int | None = None,
    rank_rows: int | None = None,
) -> DataFrame:
    """Label rows by their hash rank in the stratum.

    `bounds(total)` gives the ascending end rank of each label but the last. Ids are unique; rows that repeat one get
    the same label.
    """
    hash_of = F.coalesce(hash_rank(F.col(row_id), seed), F.lit(""))
    names = [f"_s{i}" for i in range(len(strata))]
    hashed = df.select(*[F.col(s).alias(n) for s, n in zip(strata, names, strict=True)], hash_of.alias("_hash"), F.col(row_id).alias("_id"))
    found = materialise(boundary_rows(hashed, names, bounds, digits or DIGITS, rank_rows or RANK_ROWS), "bounds")
    # Size bound: one row per stratum.
    ends = found.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("_j", "_at"))).alias("_ends"))
    own = F.struct(hash_of.alias("_hash"), F.col(row_id).alias("_id"))
    if strata:
        match = F.lit(True)
        for s, n in zip(strata, names, strict=True):
            match &= F.col(s).eqNullSafe(F.col(n))
        joined = df.withColumn("_own", own).join(ends, match, "left")
    else:
        # Size bound: one row.
        joined = df.withColumn("_own", own).crossJoin(F.broadcast(ends.agg(F.first("_ends").alias("_ends"))))
    label = F
    for j, text in enumerate(labels[:-1]):
        end = F.try_element_at("_ends", F.lit(j))
        label = label.when(end.isNull() | (F.col("_own") < end), text)
    return joined.select(*df.columns, label.otherwise(labels[-1]).alias(name))


def stratified_split(
    df: DataFrame,
    fractions: Mapping[str, float],
    strata: Sequence[str] = ("clicked",),
    row_id: str = ROW_ID,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Label rows so that every stratum is divided in the given fractions, to the row."""
    labels = list(fractions)
    ends, reached = [], 0.0
    for label in labels[:-1]:
        reached += fractions[label]
        ends.append(reached)
    return label_by_rank(
        df, strata, row_id, labels,
        lambda total: [F.floor(total * F.lit(e) + F.lit(0.5)) for e in ends],
        seed, name,
    )


def split_train_val_test(
    df: DataFrame,
    test_size: float = 0.2,
    val_size: float = 0.2,
    strata: Sequence[str] = ("clicked",),
    row_id: str = ROW_ID,
    seed: int = 42,
) -> DataFrame:
    """`split` = train, val or test; `val_size` is a share of what the test set leaves."""
    rest = 1 - test_size
    shares = {"train": rest * (1 - val_size), "val": rest * val_size, "test": test_size}
    return stratified_split(df, shares, strata, row_id, seed)


def stratified_sample(
    df: DataFrame, fraction: float, strata: Sequence[str] = ("clicked",), row_id: str = ROW_ID, seed: int = 42
) -> DataFrame:
    """The same fraction of every stratum, exact to the row."""
    if not 0 < fraction < 1:
        return df
    marked = stratified_split(df, {"in": fraction, "out": 1 - fraction}, strata, row_id, seed, "_sampled")
    return marked.filter(F.col("_sampled") == "in").drop("_sampled")


def stratified_sample_approx(df: DataFrame, fractions: Mapping, stratum: str = "clicked", seed: int = 42) -> DataFrame:
    """Bernoulli sample with its own fraction per stratum: one pass, no counts."""
    return df.sampleBy(stratum, dict(fractions), seed)


def random_sample(df: DataFrame, fraction: float, seed: int = 42, row_id: str | None = None) -> DataFrame:
    """Each row with the same chance. By the hash of `row_id`, where given, the same rows however they are stored;
    otherwise by their place in the files."""
    if row_id is None:
        return df.sample(fraction=fraction, seed=seed)
    share = F.conv(F.substring(hash_rank(F.col(row_id), seed), 1, 13), 16, 10).cast("double") / float(16**13)
    return df.filter(share < fraction)


def sample_n(df: DataFrame, n: int, row_id: str = ROW_ID, seed: int = 42) -> DataFrame:
    """A fixed number of rows, the same ones for the same seed."""
    marked = label_by_rank(df, [], row_id, ["in", "out"], lambda total: [F.lit(n)], seed, "_sampled")
    return marked.filter(F.col("_sampled") == "in").drop("_sampled")
