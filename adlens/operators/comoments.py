"""Means, variances and covariances of all pairs of columns, over the rows that have both, from one scan.

Each batch of rows is centred on its own means, turned into matrices of counts, sums and products by pair, and merged
into what the task has so far (Chan's update); the tasks' matrices are merged the same way, one matrix row per group.
Nothing is ever a difference of large sums, and a pair whose column is constant where the other is present is told
by its smallest and largest value, not by a variance that rounding leaves above zero.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

PARTS = ("n", "mean", "spread", "product", "low", "high")
SCHEMA = "line int, " + ", ".join(f"{p} array<double>" for p in PARTS)


@dataclass
class CoMoments:
    """Square matrices: entry (i, j) is about column i over the rows that have both i and j.

    `n` rows, `mean` of i, `spread` the sum of its squared deviations, `product` the sum of the deviations of i
    times those of j, `low` and `high` the extremes of i.
    """

    n: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    product: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def empty(cls, rows: int, columns: int) -> CoMoments:
        zero = [np.zeros((rows, columns)) for _ in range(4)]
        return cls(*zero, np.full((rows, columns), np.inf), np.full((rows, columns), -np.inf))

    @classmethod
    def of(cls, values: np.ndarray) -> CoMoments:
        """From rows of values, NaN where a value is missing."""
        present = ~np.isnan(values)
        mask = present.astype(float)
        low = np.where(present, values, np.inf).min(axis=0, initial=np.inf)
        high = np.where(present, values, -np.inf).max(axis=0, initial=-np.inf)
        counts = mask.sum(axis=0)
        filled = np.where(present, values, 0.0)
        centre = np.where(low < high, filled.sum(axis=0) / np.maximum(counts, 1), np.where(counts > 0, low, 0.0))
        x = np.where(present, values - centre, 0.0)
        n, sums, squares, products = mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x
        some = np.maximum(n, 1)
        lows, highs = np.repeat(low[:, None], len(low), axis=1), np.repeat(high[:, None], len(low), axis=1)
        for j in np.flatnonzero(counts < len(values)):
            both = present & present[:, [j]]
            lows[:, j] = np.where(both, values, np.inf).min(axis=0, initial=np.inf)
            highs[:, j] = np.where(both, values, -np.inf).max(axis=0, initial=-np.inf)
        return cls(n, centre[:, None] + sums / some, squares - sums * sums / some, products - sums * sums.T / some, lows, highs)

    def merged(self, other: CoMoments, mean_of_j: np.ndarray | None = None, other_mean_of_j: np.ndarray | None = None) -> CoMoments:
        """Of both sets of rows. For single lines of a matrix the means of the columns j have to be given."""
        mine = self.mean.T if mean_of_j is None else mean_of_j
        theirs = other.mean.T if other_mean_of_j is None else other_mean_of_j
        n = self.n + other.n
        some = np.maximum(n, 1)
        share = self.n * other.n / some
        by_i, by_j = other.mean - self.mean, theirs - mine
        by_i, by_j = (np.where((self.n > 0) & (other.n > 0), d, 0.0) for d in (by_i, by_j))
        mean = np.where(self.n > 0, self.mean + by_i * other.n / some, other.mean)
        return CoMoments(
            n,
            mean,
            self.spread + other.spread + by_i * by_i * share,
            self.product + other.product + by_i * by_j * share,
            np.minimum(self.low, other.low),
            np.maximum(self.high, other.high),
        )

    def correlations(self) -> np.ndarray:
        """Pearson's r; NaN where either column is constant over the common rows, or there are none."""
        constant = ~(self.low < self.high)
        with np.errstate(divide="ignore", invalid="ignore"):
            r = self.product / np.sqrt(self.spread * self.spread.T)
        return np.where(constant | constant.T, np.nan, np.clip(r, -1.0, 1.0))


def co_moments(df: DataFrame, values: Sequence[Column]) -> CoMoments:
    """Of all pairs of `values`, doubles with null (or NaN) where missing. One scan, one shuffle of matrix rows."""
    k = len(values)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = CoMoments.empty(k, k)
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1)
            own = own.merged(CoMoments.of(rows))
        # A line is merged by itself, so it carries the means of the other columns as well.
        lines = [pa.array([*getattr(own, p)], pa.list_(pa.float64())) for p in PARTS]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k), pa.int32()), *lines, pa.array([*own.mean.T], pa.list_(pa.float64()))], ["line", *PARTS, "other"]
        )

    def merge(table: pa.Table) -> pa.Table:
        parts = []
        for i in range(table.num_rows):
            cells = [table[p][i].values.to_numpy()[None, :] for p in (*PARTS, "other")]
            parts.append((CoMoments(*cells[:-1]), cells[-1]))
        parts.sort(key=lambda p: p[0].product.tobytes())  # one order, however the parts arrive
        whole, mean_j = parts[0]
        for part, part_mean in parts[1:]:
            n, before = whole.n, mean_j
            whole = whole.merged(part, before, part_mean)
            step = np.where((n > 0) & (part.n > 0), part_mean - before, 0.0)
            mean_j = np.where(n > 0, before + step * part.n / np.maximum(whole.n, 1), part_mean)
        lines = [pa.array([getattr(whole, p)[0]], pa.list_(pa.float64())) for p in PARTS]
        return pa.Table.from_arrays([table["line"][:1], *lines], names=["line", *PARTS])

    chosen = df.select(*[v.cast("double").alias(f"c{i}") for i, v in enumerate(values)])
    found = chosen.mapInArrow(partial, f"{SCHEMA}, other array<double>").groupBy("line").applyInArrow(merge, SCHEMA).toArrow()
    # Size bound: columns x columns.
    out = CoMoments.empty(k, k)
    for i, line in enumerate(found["line"].to_pylist()):
        for p in PARTS:
            getattr(out, p)[line] = found[p][i].values.to_numpy()
    return out
