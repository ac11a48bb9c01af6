"""Boosted trees grown leaf by leaf: always the leaf whose split gains most, up to a number of leaves.

Features are cut into at most 255 bins once; a row then is one byte per feature, its label, weight and margin.
A pass over the rows adds up gradients and hessians by (leaf, feature, bin) - in each task first, then by one
shuffle of sums - and the driver, which sees only these sums, takes the best split of each leaf. Of two new leaves
only the smaller is added up; the other is its parent minus it. A queue of leaves by gain decides which to split
next. So that a tree needs a pass per level and not one per split, a pass adds up the children of every leaf that
waits in the queue, not just of the first; the trees are the same as without that look ahead.

Margins are written every few rounds and computed from the trees since then in between, so no pass evaluates more
than `write_every` trees, and only for rows whose sums are wanted. The loss on held-out rows comes with the first pass
of the next tree. What the driver holds is bounded by leaves x features x bins, whatever the number of rows.

Rows are stored in blocks: a record has the values of up to `BLOCK` rows, one column for each feature, so a pass hands
over arrays and not rows, and reads only the features it asks for.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.sources.materialise import materialise

BINS = 255
#: Rows of a record, and records that a pass works on at a time.
BLOCK, RECORDS = 256, 256
TREE_SCHEMA = "tree int, node int, feature int, threshold double, bin int, left int, right int, value double, gain double, rows double"
META_SCHEMA = "base double, rounds int, features int"


@dataclass
class Node:
    """A leaf until it is split."""

    depth: int
    gradient: float
    hessian: float
    rows: float
    feature: int = -1
    bin: int = -1
    gain: float = 0.0
    left: int = -1
    right: int = -1
    value: float = 0.0
    histogram: np.ndarray | None = field(default=None, repr=False)


@dataclass
class Options:
    leaves: int = 31
    max_depth: int = 6
    step_size: float = 0.1
    rounds: int = 100
    subsample: float = 0.8
    column_sample: float = 0.8
    least_rows: int = 20
    least_hessian: float = 1e-3
    ridge: float = 0.0
    patience: int = 10
    seed: int = 42
    write_every: int = 8


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A share in [0, 1) for each key, the same wherever the row is."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53


def shape_of(nodes: Sequence[Node]) -> tuple[np.ndarray, ...]:
    """Feature, cut, left and right child of every node: all that routing needs."""
    return tuple(np.array([getattr(n, name) for n in nodes]) for name in ("feature", "bin", "left", "right"))


def routes(shape: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """The leaf of each row, all rows one level at a time: the plain form of `reached`."""
    feature, cut, left, right = shape
    at = np.zeros(len(bins), np.int64)
    moving = np.flatnonzero(left[at] >= 0)
    while len(moving):
        here = at[moving]
        goes_left = bins[moving, feature[here]] <= cut[here]
        at[moving] = np.where(goes_left, left[here], right[here])
        moving = moving[left[at[moving]] >= 0]
    return at


Tables = tuple[list[tuple[int, np.ndarray]], np.ndarray]


def reach_tables(nodes: Sequence[Node], leaves: Sequence[int]) -> Tables:
    """For every feature that the tree asks, by bin, a bit for each of the `leaves` that its cuts leave open; and the
    bits of all. A row is in the one leaf whose bit all features leave it, and in none of the `leaves` without a bit."""
    words, place = max(1, -(-len(leaves) // 64)), {k: i for i, k in enumerate(leaves)}
    cuts: list[tuple[int, int, np.ndarray, np.ndarray]] = []

    def visit(k: int) -> np.ndarray:
        bits = np.zeros(words, np.uint64)
        if nodes[k].left < 0:
            if k in place:
                bits[place[k] // 64] = np.uint64(1 << place[k] % 64)
            return bits
        left, right = visit(nodes[k].left), visit(nodes[k].right)
        cuts.append((nodes[k].feature, nodes[k].bin, left, right))
        return left | right

    whole = visit(0)
    tables = {f: np.repeat(whole[:, None], BINS + 1, axis=1) for f in sorted({c[0] for c in cuts})}
    for f, cut, left, right in cuts:
        tables[f][:, : cut + 1] &= ~right[:, None]
        tables[f][:, cut + 1 :] &= ~left[:, None]
    return list(tables.items()), whole


def reached(tables: Tables, bins: Mapping[int, np.ndarray] | Sequence[np.ndarray], rows: int) -> np.ndarray:
    """The number of each row's leaf in the list that `tables` were made for, -1 for other leaves."""
    asked, whole = tables
    out = np.full(rows, -1, np.int64)
    for word in range(len(whole)):
        bits = np.full(rows, whole[word])
        for feature, table in asked:
            bits &= table[word].take(bins[feature])
        # One bit at most: its exponent is the place.
        found = np.frexp(bits.astype(float))[1] - 1
        out = np.where(found >= 0, found + 64 * word, out) if word else found.astype(np.int64)
    return out


def scorer(nodes: Sequence[Node]) -> tuple[Tables, np.ndarray]:
    """Tables of all leaves of a tree, and their values."""
    leaves = [k for k, n in enumerate(nodes) if n.left < 0]
    return reach_tables(nodes, leaves), np.array([nodes[k].value for k in leaves])


def margins_of(scorers: Sequence[tuple[Tables, np.ndarray]], bins: Mapping[int, np.ndarray] | Sequence[np.ndarray], start: np.ndarray) -> np.ndarray:
    out = start.copy()
    for tables, values in scorers:
        out += values.take(reached(tables, bins, len(start)))
    return out


def best_split(histogram: np.ndarray, features: Sequence[int], options: Options) -> tuple[float, int, int]:
    """(gain, feature, bin) of the best cut of a leaf's sums, shaped (feature, bin, 3); gain 0 if there is none."""
    left = np.cumsum(histogram, axis=1)[:, :-1]
    whole = histogram.sum(axis=1, keepdims=True)
    right = whole - left

    def score(part: np.ndarray) -> np.ndarray:
        return part[..., 0] ** 2 / np.maximum(part[..., 1] + options.ridge, 1e-300)

    gain = score(left) + score(right) - score(whole)
    for part in (left, right):
        gain = np.where((part[..., 2] >= options.least_rows) & (part[..., 1] >= options.least_hessian), gain, 0.0)
    if not gain.size:
        return 0.0, -1, -1
    at = int(np.argmax(gain))
    line, cut = divmod(at, gain.shape[1])
    return float(gain[line, cut]), int(features[line]), int(cut)


class LeafwiseModel:
    """Trees as a table of nodes; scores vectors like the models of Spark ML."""

    def __init__(self, base: float, trees: list[list[Node]], edges: list[np.ndarray], losses: list[float] | None = None):
        self.base, self.trees, self.edges, self.losses = base, trees, edges, losses or []

    @property
    def numFeatures(self) -> int:  # noqa: N802 - the name models of Spark ML use
        return len(self.edges)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        """Share of each feature in the summed gain."""
        gains = np.zeros(len(self.edges))
        for node in (n for t in self.trees for n in t if n.left >= 0):
            gains[node.feature] += node.gain
        return DenseVector(gains / gains.sum() if gains.sum() else gains)

    def nodes(self) -> list[tuple]:
        """Rows of TREE_SCHEMA; a row goes left if its value is at most the threshold."""
        out = []
        for t, nodes in enumerate(self.trees):
            for k, n in enumerate(nodes):
                threshold = float(self.edges[n.feature][n.bin]) if n.left >= 0 else None
                out.append((t, k, n.feature, threshold, n.bin, n.left, n.right, float(n.value), float(n.gain), float(n.rows)))
        return out

    def margin(self, values: np.ndarray) -> np.ndarray:
        """Log-odds of rows of feature values."""
        return self._margin([scorer(t) for t in self.trees], values)

    def _margin(self, scorers: Sequence[tuple[Tables, np.ndarray]], values: np.ndarray) -> np.ndarray:
        return margins_of(scorers, binned(values, self.edges).T, np.full(len(values), self.base))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `probability` and `prediction` to rows with a `features` vector."""
        scorers, margin = [scorer(t) for t in self.trees], self._margin

        @F.pandas_udf("double")
        def rate(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=float)
            return pd.Series(1.0 / (1.0 + np.exp(-margin(scorers, np.stack(vectors.to_numpy())))))

        scored = df.withColumn("_rate", rate(vector_to_array("features")))
        return scored.withColumns(
            {
                "probability": array_to_vector(F.array(1 - F.col("_rate"), F.col("_rate"))),
                "prediction": (F.col("_rate") > 0.5).cast("double"),
            }
        ).drop("_rate")

    def save(self, spark: SparkSession, path: str, overwrite: bool = False) -> None:
        mode = "overwrite" if overwrite else "error"
        edges = [(i, [float(e) for e in edge]) for i, edge in enumerate(self.edges)]
        parts = {
            "nodes": spark.createDataFrame(self.nodes(), TREE_SCHEMA),
            "edges": spark.createDataFrame(edges, "feature int, edges array<double>"),
            "meta": spark.createDataFrame([(self.base, len(self.trees), len(self.edges))], META_SCHEMA),
        }
        for name, part in parts.items():
            part.coalesce(1).write.mode(mode).parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LeafwiseModel:
        meta = spark.read.parquet(f"{path}/meta").first()
        found = {r["feature"]: np.array(r["edges"], float) for r in spark.read.parquet(f"{path}/edges").collect()}
        trees: list[list[Node]] = [[] for _ in range(meta["rounds"])]
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            node = Node(0, 0.0, 0.0, r["rows"], r["feature"], r["bin"], r["gain"], r["left"], r["right"], r["value"])
            trees[r["tree"]].append(node)
        return cls(meta["base"], trees, [found[i] for i in range(meta["features"])])

    def write(self) -> _Writer:
        return _Writer(self)


class _Writer:
    """`model.write().overwrite().save(path)`, as for models of Spark ML."""

    def __init__(self, model: LeafwiseModel):
        self.model, self.replaces = model, False

    def overwrite(self) -> _Writer:
        self.replaces = True
        return self

    def save(self, path: str) -> None:
        self.model.save(SparkSession.getActiveSession(), path, self.replaces)


def bin_edges(rows: DataFrame, width: int, bins: int = BINS, accuracy: int = 10_000) -> list[np.ndarray]:
    """Inner cut points of each feature: quantiles by mergeable sketches, doubled values once."""
    shares = [k / bins for k in range(1, bins)]
    values = rows.select(vector_to_array("features").alias("v"))
    one = values.agg(*[F.percentile_approx(F.col("v")[i], shares, accuracy).alias(f"f{i}") for i in range(width)]).first()
    return [np.unique(np.array(one[f"f{i}"] or [], float)) for i in range(width)]


def binned(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """One byte per feature: bin k holds the values above edge k - 1, up to edge k."""
    out = np.zeros(values.shape, np.uint8, order="F")
    for i, edge in enumerate(edges):
        out[:, i] = np.searchsorted(edge, values[:, i], side="left")
    return out


def blocked(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Values as records of the given lengths."""
    ends = np.concatenate([[0], np.cumsum(lengths * values.itemsize)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def unblocked(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """All values of a column of records, as they lie in memory."""
    column = batch.column(name)
    _, places, data = column.buffers()
    wide = pa.types.is_large_binary(column.type)
    ends = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(KINDS.get(name, np.uint8))


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same records, `RECORDS` at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, RECORDS):
            yield batch.slice(at, RECORDS)


#: Columns of a record besides `b0`, `b1`, ... of the features' bins; `held` and bins are bytes.
KINDS = {"key": np.int64, "label": np.float64, "weight": np.float64, "held": np.uint8, "margin": np.float64}


class LeafwiseTrainer:
    """Fits on rows of `features` (vector), `label`, `_weight`, `_key` (long) and `_held` (boolean)."""

    def __init__(self, rows: DataFrame, width: int, options: Options):
        self.width, self.options = width, options
        self.edges = bin_edges(rows.filter("NOT _held"), width)
        edges = self.edges
        positives = rows.filter("NOT _held").agg(F.sum(F.col("label") * F.col("_weight")), F.sum("_weight")).first()
        # Sums travel as whole numbers, so that their order does not matter; no sum can exceed the total weight
        # (of held-out rows: their loss, far below a thousand times it).
        total = rows.agg(F.sum("_weight")).first()[0] or 1.0
        self.scale = 2.0 ** (50 - int(np.ceil(np.log2(max(total, 1.0)))))
        share = min(max((positives[0] or 0.0) / positives[1], 1e-6), 1 - 1e-6) if positives[1] else 0.5
        self.base = float(np.log(share / (1 - share)))
        base = self.base

        def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                values = batch.column("v").values.to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(edges))
                whole, rest = divmod(batch.num_rows, BLOCK)
                lengths = np.array([BLOCK] * whole + [rest] * (rest > 0))
                own = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("_key", "label", "_weight", "_held")]
                columns = [c.astype(k) for c, k in zip([*own, np.full(batch.num_rows, base)], KINDS.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([blocked(c, lengths) for c in [*columns, *binned(values, edges).T]], names)

        names = [*KINDS, *[f"b{i}" for i in range(width)]]
        narrow = rows.select("_key", "label", "_weight", "_held", vector_to_array("features").alias("v"))
        self.schema = ", ".join(f"{c} binary" for c in names)
        self.rows = materialise(narrow.mapInArrow(bin_rows, self.schema), "leafwise")
        self.trees: list[list[Node]] = []
        self.since: list[tuple[Tables, np.ndarray]] = []

    def write_margins(self) -> None:
        since = self.since
        asked = sorted({f for (tables, _), _ in since for f, _ in tables})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                start = unblocked(batch, "margin")
                margin = margins_of(since, {f: unblocked(batch, f"b{f}") for f in asked}, start)
                lengths = pc.binary_length(batch.column("held")).to_numpy()
                yield batch.set_column(batch.schema.get_field_index("margin"), "margin", blocked(margin, lengths))

        self.rows = materialise(self.rows.mapInArrow(run, self.schema), "leafwise")
        self.since = []

    def sums(self, nodes: list[Node], wanted: list[int], features: list[int], tree: int, loss: bool) -> tuple[dict, tuple[float, float]]:
        """Sums (feature, bin, 3) of gradient, hessian and rows by wanted leaf; and loss and weight of held-out rows."""
        since, options, scale = self.since, self.options, self.scale
        own_tree = reach_tables(nodes, wanted)
        scored = {f for (tables, _), _ in since for f, _ in tables}
        asked = sorted(scored | {f for f, _ in own_tree[0]} | set(features))

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros((len(features), 3, len(wanted) * (BINS + 1)))
            held_out = np.zeros(2)
            for batch in pieces(batches):
                key, label, weight, held, margin = (unblocked(batch, c) for c in KINDS)
                bins = {f: unblocked(batch, f"b{f}") for f in asked}

                def margins(at: np.ndarray) -> np.ndarray:
                    return margins_of(since, {f: bins[f][at] for f in scored}, margin[at])

                if loss and held.any():
                    at = np.flatnonzero(held)
                    signed = margins(at)
                    signed = np.where(label[at] > 0.5, -signed, signed)
                    held_out += (weight[at] * np.logaddexp(0.0, signed)).sum(), weight[at].sum()
                if not wanted:
                    continue
                leaf = reached(own_tree, bins, len(key))
                used = np.flatnonzero((leaf >= 0) & (held == 0) & (mixed(key, options.seed + 1000 * tree) < options.subsample))
                if not len(used):
                    continue
                rate = 1.0 / (1.0 + np.exp(-margins(used)))
                gradient, hessian = weight[used] * (rate - label[used]), weight[used] * rate * (1 - rate)
                first = leaf[used] * (BINS + 1)
                for j, f in enumerate(features):
                    slot = first + bins[f][used]
                    for k, value in enumerate((gradient, hessian, None)):
                        own[j, k] += np.bincount(slot, value, own.shape[2])
            own = own.reshape(len(features), 3, len(wanted), BINS + 1).transpose(2, 0, 3, 1)
            at = np.nonzero(own[..., 2])
            cells = np.rint(own[at] * np.array([scale, scale, 1])).astype(np.int64)
            lines = [np.append(c, -1) for c in at]
            sums = [np.append(cells[:, k], v) for k, v in enumerate([*np.rint(held_out * scale).astype(np.int64), 0])]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int32()) for c in lines], *[pa.array(c, pa.int64()) for c in sums]], [*cell, *values]
            )

        cell, values = ["leaf", "line", "bin"], ["gradient", "hessian", "rows"]
        found = (
            self.rows.select(*KINDS, *[f"b{f}" for f in asked])
            .mapInArrow(partial, "leaf int, line int, bin int, gradient long, hessian long, rows long")
            .groupBy(*cell)
            .agg(*[F.sum(v).alias(v) for v in values])
            .toArrow()  # size bound: leaves x features x bins
        )
        leaf, line, slot = (found[c].to_numpy() for c in cell)
        cells = np.stack([found[v].to_numpy() for v in values], axis=1) / np.array([scale, scale, 1])
        out = np.zeros((len(wanted), len(features), BINS + 1, 3))
        inner = leaf >= 0
        out[leaf[inner], line[inner], slot[inner]] = cells[inner]
        held_out = cells[~inner].sum(axis=0)
        return {n: out[i] for i, n in enumerate(wanted)}, (float(held_out[0]), float(held_out[1]))

    def grow(self, tree: int) -> tuple[list[Node], float]:
        """One tree, and the loss of the trees before it on the held-out rows (nan without such rows)."""
        options, rng = self.options, np.random.default_rng(self.options.seed + tree)
        some = max(1, round(self.width * options.column_sample))
        features = sorted(rng.choice(self.width, some, replace=False).tolist())
        nodes = [Node(0, 0.0, 0.0, 0.0)]
        first, (loss, weight) = self.sums(nodes, [0], features, tree, True)
        self._settle(nodes[0], first[0], features)
        order, queue = count(), []
        if nodes[0].gain > 0:
            heapq.heappush(queue, (-nodes[0].gain, next(order), 0))
        leaves = 1
        while queue and leaves < options.leaves:
            _, _, k = heapq.heappop(queue)
            if nodes[k].left < 0:
                self._look_ahead(nodes, [k, *[q[2] for q in queue]], features, tree)
            leaves += 1
            for child in (nodes[k].left, nodes[k].right):
                if nodes[child].gain > 0 and nodes[child].depth < options.max_depth:
                    heapq.heappush(queue, (-nodes[child].gain, next(order), child))
            nodes[k].value = np.nan  # taken for good
        return self._final(nodes), loss / weight if weight else float("nan")

    def _settle(self, node: Node, histogram: np.ndarray, features: list[int]) -> None:
        node.histogram = histogram
        node.gradient, node.hessian, node.rows = histogram[0].sum(axis=0) if len(histogram) else (0.0, 0.0, 0.0)
        node.gain, node.feature, node.bin = best_split(histogram, features, self.options)

    def _look_ahead(self, nodes: list[Node], waiting: list[int], features: list[int], tree: int) -> None:
        """Split all waiting leaves on trial and add up the smaller child of each in one pass."""
        small: dict[int, tuple[int, int, np.ndarray]] = {}
        for k in waiting:
            if nodes[k].left >= 0:
                continue
            line = features.index(nodes[k].feature)
            rows_left = nodes[k].histogram[line, : nodes[k].bin + 1, 2].sum()
            nodes[k].left, nodes[k].right = len(nodes), len(nodes) + 1
            nodes += [Node(nodes[k].depth + 1, 0.0, 0.0, 0.0), Node(nodes[k].depth + 1, 0.0, 0.0, 0.0)]
            smaller_is_left = rows_left * 2 <= nodes[k].rows
            child = nodes[k].left if smaller_is_left else nodes[k].right
            small[child] = (k, nodes[k].right if smaller_is_left else nodes[k].left, nodes[k].histogram)
        found, _ = self.sums(nodes, list(small), features, tree, False)
        for child, (_, other, whole) in small.items():
            self._settle(nodes[child], found[child], features)
            self._settle(nodes[other], whole - found[child], features)

    def _final(self, nodes: list[Node]) -> list[Node]:
        """The tree without the splits that were only tried, numbered from its root."""
        out: list[Node] = []

        def copy(k: int) -> int:
            n, at = nodes[k], len(out)
            split = n.left >= 0 and np.isnan(n.value)
            out.append(Node(n.depth, n.gradient, n.hessian, n.rows))
            if split:
                out[at].feature, out[at].bin, out[at].gain = n.feature, n.bin, n.gain
                out[at].left = copy(n.left)
                out[at].right = copy(n.right)
            else:
                below = n.hessian + self.options.ridge
                out[at].value = float(-n.gradient / below * self.options.step_size) if below > 0 else 0.0
            return at

        copy(0)
        return out

    def fit(self) -> LeafwiseModel:
        """All rounds, or up to the round with the smallest held-out loss before `patience` rounds without a smaller one."""
        losses: list[float] = []
        for tree in range(self.options.rounds):
            if len(self.since) >= self.options.write_every:
                self.write_margins()
            nodes, loss = self.grow(tree)
            if tree:
                losses.append(loss)
                if not np.isnan(loss) and len(losses) - 1 - int(np.argmin(losses)) >= self.options.patience:
                    break
            self.trees.append(nodes)
            self.since.append(scorer(nodes))
        else:
            _, (loss, weight) = self.sums([Node(0, 0, 0, 0)], [], [], 0, True)
            losses.append(loss / weight if weight else float("nan"))
        if losses and not np.isnan(losses).any():
            self.trees = self.trees[: int(np.argmin(losses)) + 1]
        return LeafwiseModel(self.base, self.trees, self.edges, losses)
