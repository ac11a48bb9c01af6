"""Whiten embeddings by shifted CholeskyQR.

Entries are read as whole numbers x = floor(scale * c) + offset; column sums S are whole numbers too, so the centred
rows (n * x - S) / n are exact up to one rounding. Passes over the rows then orthogonalise them: each pass divides
the centred rows by the triangular factors found so far (forward substitution, in the tasks), adds up the Gram
matrix of what comes out, and the driver takes its Cholesky factor. The first factor is taken of a shifted Gram
matrix, so that it exists however badly conditioned the rows are; a later pass is shifted again only while its
matrix is not yet safely positive. The factors are composed, R = R_k ... R_1, and the singular value decomposition
of R gives the components (right vectors) and, over the root of n, their standard deviations. The rows' covariance
is never factored itself, so small components keep their digits.

Between tasks and driver go sums of one matrix row each, added up by a shuffle; the driver holds a few matrices
of dimension x dimension, whatever the number of rows. The rows themselves are read again for each pass.

Defined cases: a row is left out if its vector is null or holds a null or an entry that is not finite; vectors
shorter than the longest are read as if zeros followed; a component without variance (rank deficient rows, constant
columns, fewer rows than columns) is not returned, so equal vectors alone give no rows; repeated ids are rows of
their own; an empty table gives none. Entries with |scale * c| of 2**52 or more raise an error, as does a deviation
that does not fit a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Passes after which directions that are still not orthogonal have no variance.
MOST_PASSES = 6
EPS = float(np.finfo(np.float64).eps)
#: Rows of a block of the triangular solve.
BLOCK = 4096


@dataclass
class Whitening:
    """What the fit found: `components` are the columns, by falling variance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    total: float

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.total


def whole_rows(column: pa.Array, dims: int | None, scale: int, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the rows that count, their lengths and their whole numbers, padded to `dims` (longest if None)."""
    lists = column.cast(pa.list_(pa.float64()))
    starts = lists.offsets.to_numpy()
    flat = lists.values
    good = np.isfinite(flat.to_numpy(zero_copy_only=False))
    before = np.concatenate([[0], np.cumsum(~good)])
    valid = np.asarray(lists.is_valid()) & (before[starts[1:]] == before[starts[:-1]])
    at = np.flatnonzero(valid)
    first, sizes = starts[:-1][at], np.diff(starts)[at]
    dims = int(sizes.max(initial=0)) if dims is None else dims
    entries = flat.to_numpy(zero_copy_only=False)
    if len(at) and (sizes == dims).all():
        picked = entries[first[:, None] + np.arange(dims)]
    else:
        picked = np.zeros((len(at), dims))
        for i, (start, size) in enumerate(zip(first, sizes, strict=True)):
            picked[i, :size] = entries[start : start + size]
    picked = np.floor(scale * picked)
    if np.abs(picked).max(initial=0) >= 2.0**52:
        raise ValueError("an entry is too large for a whole number")
    return at, sizes, picked.astype(np.int64) + offset


def forward(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """`rows` times the inverse of an upper triangle, column by column."""
    out = np.empty_like(rows)
    for j in range(upper.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x minus the mean; the difference is exact, only its quotient is rounded."""
    return (n * x - sums) / n


def _matrix_sum(df: DataFrame, make: Callable[[pa.Array], np.ndarray], height: int, width: int) -> np.ndarray:
    """Sum over all batches of `make`, a matrix: summed in each task, then row by row over the tasks."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((height, width))
        for batch in batches:
            own += make(batch.column(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(height), pa.int32()), pa.array(list(own), pa.list_(pa.float64()))], ["line", "cells"]
        )

    def add(table: pa.Table) -> pa.Table:
        cells = np.sum(np.stack([c.values.to_numpy() for c in table["cells"]]), axis=0)
        return pa.table({"line": table["line"][:1], "cells": pa.array([cells], pa.list_(pa.float64()))})

    schema = "line int, cells array<double>"
    found = df.mapInArrow(partial, schema).groupBy("line").applyInArrow(add, schema).toArrow()
    out = np.zeros((height, width))
    for line, cells in zip(found["line"].to_pylist(), found["cells"], strict=True):
        out[line] = cells.values.to_numpy()
    return out


def _totals(vectors: DataFrame, scale: int, offset: int) -> tuple[int, np.ndarray]:
    """Number of rows and exact column sums."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, filled, sums = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            at, sizes, x = whole_rows(batch.column(0), None, scale, offset)
            n += len(at)
            if x.shape[1] > len(sums):
                more = x.shape[1] - len(sums)
                filled, sums = np.pad(filled, (0, more)), np.pad(sums, (0, more))
            dims = x.shape[1]
            filled[:dims] += (sizes[:, None] > np.arange(dims)).sum(axis=0)
            sums[:dims] += np.where(sizes[:, None] > np.arange(dims), x, 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([-1, *range(len(sums))], pa.int32()),
                pa.array([n, *filled.tolist()], pa.int64()),
                pa.array([0, *sums.tolist()], pa.int64()),
            ],
            ["col", "filled", "total"],
        )

    parts = vectors.mapInArrow(partial, "col int, filled long, total long")
    found = {
        r["col"]: (r["filled"], r["total"])
        for r in parts.groupBy("col").agg(F.sum("filled").alias("filled"), F.sum("total").alias("total")).collect()
    }
    n = found.pop(-1, (0, 0))[0]
    return n, np.array([total + (n - filled) * offset for _, (filled, total) in sorted(found.items())], np.int64)


def _factor(gram: np.ndarray, n: int, shift: bool) -> np.ndarray:
    """Upper Cholesky factor, of the matrix shifted by Fukaya et al.'s bound if asked for."""
    d = gram.shape[0]
    by = 11.0 * (n * d + d * (d + 1)) * EPS * np.linalg.norm(gram, 2) if shift else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + by * np.eye(d)).T
        except np.linalg.LinAlgError:
            by = max(10 * by, EPS * float(np.trace(gram)))


def decompose(factors: list[np.ndarray], gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right vectors of the centred rows Q R, where Q'Q is `gram` and R the composed factors."""
    values, vectors = np.linalg.eigh(gram)
    whole = np.sqrt(np.clip(values, 0, None))[:, None] * vectors.T
    for r in reversed(factors):
        whole = whole @ r
    _, sigma, right = np.linalg.svd(whole)
    # A sign of its own for each component: its largest entry is positive.
    lead = right[np.arange(len(right)), np.argmax(np.abs(right), axis=1)]
    return sigma, (right * np.where(lead < 0, -1.0, 1.0)[:, None]).T


def fit_whitening(vectors: DataFrame, most: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """Fit on all rows of a table of one array column; None if there is no variance."""
    n, sums = _totals(vectors, scale, offset)
    d = len(sums)
    if not n or not d:
        return None
    factors: list[np.ndarray] = []

    def gram_of(column: pa.Array) -> np.ndarray:
        _, _, x = whole_rows(column, d, scale, offset)
        out = np.zeros((d, d))
        for start in range(0, len(x), BLOCK):
            q = centred(x[start : start + BLOCK], n, sums)
            for r in factors:
                q = forward(q, r)
            out += q.T @ q
        return out

    gram = _matrix_sum(vectors, gram_of, d, d)
    total = float(np.trace(gram)) / n
    if total == 0.0:
        return None
    for step in range(MOST_PASSES):
        # Columns of unit length in the first pass would hide nothing: the shift is relative to the largest one.
        factors.append(_factor(gram, n, step == 0 or float(np.linalg.eigvalsh(gram)[0]) < 0.1))
        gram = _matrix_sum(vectors, gram_of, d, d)
        if step and np.abs(gram - np.eye(d)).max() < 1e-12 * d:
            break
    sigma, right = decompose(factors, gram)
    kept = min(most, int((sigma > sigma[0] * 64 * d * EPS).sum()), max(n - 1, 0))
    return Whitening(n, sums, right[:, :kept], sigma[:kept] ** 2 / n, total)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Sum over dimensions of (n * x - S) ** 2, exact."""
    most = float(np.abs(n * x.astype(np.float64) - sums).max(initial=0))
    if most * most * max(1, x.shape[1]) < 2.0**62:
        return ((n * x - sums) ** 2).sum(axis=1)
    exact = ((x.astype(object) * n - sums.astype(object)) ** 2).sum(axis=1)
    if any(v >= 2**63 for v in exact):
        raise OverflowError("a deviation does not fit a long")
    return exact.astype(np.int64)


def whiten(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    most: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> tuple[DataFrame, Whitening | None]:
    """`id`, `deviation`, `whitened` (an array by component) of each row that counts, and the fit.

    Without a fit (no rows, or no variance) the table is empty.
    """
    rows = df.select(F.col(f"`{vector_col}`").cast("array<double>").alias("vector"), F.col(f"`{id_col}`").alias("id"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, deviation long, whitened array<double>"
    fit = fit_whitening(rows.select("vector"), most, scale, offset)
    if fit is None:
        return rows.sparkSession.createDataFrame([], schema), None
    n, sums, turn = fit.n, fit.sums, fit.components / np.sqrt(fit.variances)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, _, x = whole_rows(batch.column(0), len(sums), scale, offset)
            out = centred(x, n, sums) @ turn
            cells = pa.ListArray.from_arrays(
                np.arange(len(at) + 1, dtype=np.int32) * turn.shape[1], pa.array(out.ravel(), pa.float64())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(at)), pa.array(deviations(x, n, sums), pa.int64()), cells],
                ["id", "deviation", "whitened"],
            )

    return rows.mapInArrow(project, schema), fit


def identity_error(vectors: DataFrame, fit: Whitening, scale: int = SCALE, offset: int = OFFSET) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured in a pass of its own."""
    n, sums, k = fit.n, fit.sums, len(fit.variances)
    turn = fit.components / np.sqrt(fit.variances)

    def moments(column: pa.Array) -> np.ndarray:
        _, _, x = whole_rows(column, len(sums), scale, offset)
        y = centred(x, n, sums) @ turn
        return np.vstack([y.T @ y, y.sum(axis=0)])

    found = _matrix_sum(vectors, moments, k + 1, k)
    mean = found[k] / n
    return float(np.abs(found[:k] / n - np.outer(mean, mean) - np.eye(k)).max())
