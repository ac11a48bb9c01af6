"""Exact quantiles of many columns from two scans, without a shuffle of the rows.

The first scan carries a KLL sketch of each column beside whatever else is asked of it. A sketch is off by a known
small share of the ranks, so it gives two values between which a quantile surely (up to its 99 % bound) lies. The
second scan counts the values below each bracket and, per distinct value, inside it; only these few are shuffled,
after each task has merged equal ones. Where a bracket proves wrong it is widened and that column read again, so the
result is exact, whatever the sketch said.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.operators.ordered import running
from adlens.sources.materialise import materialise

SKETCH_K = 4096
#: Published bound of the rank error of such a sketch, as a share of all ranks, at 99 % confidence.
RANK_ERROR = 2.296 / SKETCH_K**0.9723
#: Distinct values a task merges before it sends them on.
MOST_VALUES = 200_000
FOUND = "quantile int, value double, n long"


def sketch_of(value: Column) -> Column:
    """Aggregate for the first scan: mergeable, bounded by SKETCH_K."""
    return F.kll_sketch_agg_double(value, SKETCH_K)


def bracket_ends(sketch: Column, p: float, error: float) -> tuple[Column, Column]:
    """Values of the ranks `error` below and above `p`; null where that leaves the ranks there are, or of no values."""

    def at(rank: float) -> Column:
        known = F.kll_sketch_get_n_double(sketch) > 0
        return F.when(known & F.lit(0 < rank < 1), F.kll_sketch_get_quantile_double(sketch, F.lit(min(max(float(rank), 0.0), 1.0))))

    return at(p - error), at(p + error)


def select_inside(values: DataFrame, brackets: Sequence[tuple[int, str, float, float]]) -> DataFrame:
    """(`quantile`, `value`, `n`) of the values inside each bracket (number, column, low, high), and with a null
    value the number of values below it."""
    columns = list(dict.fromkeys(b[1] for b in brackets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = dict.fromkeys((b[0] for b in brackets), 0)
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {b[0]: [] for b in brackets}
        waiting = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for q, parts in held.items():
                if parts:
                    found, n = _merged(parts)
                    yield _batch(np.full(len(found), q), pa.array(found), n)
                    parts.clear()

        for batch in batches:
            arrays = {c: batch.column(c).drop_null().to_numpy(zero_copy_only=False) for c in columns}
            for q, column, low, high in brackets:
                v = arrays[column]
                below[q] += int((v < low).sum())
                inside = v[(v >= low) & (v <= high)]
                if len(inside):
                    held[q].append(np.unique(inside, return_counts=True))
                    waiting += len(held[q][-1][0])
            if waiting > MOST_VALUES:
                held = {q: [_merged(parts)] if parts else [] for q, parts in held.items()}
                waiting = sum(len(parts[0][0]) for parts in held.values() if parts)
                if waiting > MOST_VALUES // 2:
                    yield from sent()
                    waiting = 0
        yield from sent()
        yield _batch(np.array([*below]), pa.nulls(len(below), pa.float64()), np.array([*below.values()]))

    return values.select(*columns).mapInArrow(run, FOUND).groupBy("quantile", "value").agg(F.sum("n").alias("n"))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    values, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return values, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)


def _batch(quantile: np.ndarray, value: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(quantile.astype(np.int32)), value, pa.array(n.astype(np.int64))], ["quantile", "value", "n"]
    )


def exact_in_brackets(
    values: DataFrame,
    counts: Mapping[str, int],
    ends: Mapping[tuple[str, float], tuple[float | None, float | None]],
) -> dict[tuple[str, float], float | None]:
    """Linear-interpolated quantiles by (column, p).

    `counts` are the numbers of values that are not null, `ends` the brackets of the first scan (null: open). NaN
    must have been made null. A bracket that misses its quantile is opened to that side and tried again.
    """
    out: dict[tuple[str, float], float | None] = {k: None for k in ends}
    open_ends = {
        k: [-np.inf if low is None else low, np.inf if high is None else high] for k, (low, high) in ends.items() if counts[k[0]]
    }
    while open_ends:
        asked = [(i, k[0], *span) for i, (k, span) in enumerate(open_ends.items())]
        found = materialise(select_inside(values, asked), "brackets")
        below = {r["quantile"]: r["n"] for r in found.filter("value IS NULL").collect()}
        ranks = {i: (counts[k[0]] - 1) * k[1] for i, k in enumerate(open_ends)}
        wanted = values.sparkSession.createDataFrame(
            [(i, int(np.floor(r)), int(np.ceil(r)), below.get(i, 0)) for i, r in ranks.items()],
            "quantile int, low long, high long, below long",
        )
        inside = running(found.filter("value IS NOT NULL"), ["quantile"], ["value"], sums={"before": F.col("n")})
        # Size bound: one row per column and quantile.
        placed = inside.join(F.broadcast(wanted), "quantile").withColumn("first", F.col("before") + F.col("below"))
        last = F.col("first") + F.col("n") - 1
        picked = {
            r["quantile"]: r
            for r in placed.groupBy("quantile")
            .agg(*[F.max(F.when(F.col(c).between(F.col("first"), last), F.col("value"))).alias(c) for c in ("low", "high")])
            .collect()
        }
        again = {}
        for i, (k, span) in enumerate(open_ends.items()):
            low, high = (picked[i]["low"], picked[i]["high"]) if i in picked else (None, None)
            if low is not None and high is not None:
                out[k] = low if low == high else float(low + (high - low) * (ranks[i] - np.floor(ranks[i])))
            else:
                missed_below = below.get(i, 0) > np.floor(ranks[i])
                again[k] = [-np.inf, span[1]] if missed_below else [span[0], np.inf]
        open_ends = again
    return out
