"""Quality of documents: histogram gradient-boosted trees over document statistics.

Statistics come from the whole text, in Arrow batches. The trees are fitted in numpy on a bounded sample
of labelled rows (`SAMPLE_PER_LABEL` ids of each label), in one task, and flattened into arrays: a level of
a tree is one vectorised comparison for all rows of a batch.

Defined cases: a null text counts as empty; an empty text has statistics 0 and a score; with no labelled
rows or one label only, every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.sampling import fit_in_one_task, labelled_sample

SAMPLE_PER_LABEL = 8_000
TREES, DEPTH, BINS, RATE, PENALTY, LEAST_WEIGHT = 80, 4, 64, 0.15, 2.0, 20.0

NAMES = (
    "log_chars", "log_words", "word_length", "upper", "digits", "spaces", "ascii_marks", "other_bytes",
    "bars", "hashes", "stars", "percents", "dollars", "ampersands", "exclamations", "periods", "commas",
    "distinct_words", "top_word", "repeated_lines", "line_words", "short_lines", "marked_words", "upper_words",
)


def statistics(text: str | None) -> list[float]:
    body = (text or "").encode("utf-8", "surrogatepass")
    if not body:
        return [0.0] * len(NAMES)
    seen = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    n = len(body)
    share = lambda chars: float(sum(seen[ord(c)] for c in chars)) / n
    words, lines = body.split(), body.split(b"\n")
    count = max(len(words), 1)
    tally = Counter(words)
    marks = seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum()
    sample = tally.items()
    lengths = sum(len(w) * k for w, k in sample)
    return [
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        lengths / count,
        float(seen[65:91].sum()) / n,
        float(seen[48:58].sum()) / n,
        float(seen[9:14].sum() + seen[32]) / n,
        float(marks) / n,
        float(seen[128:].sum()) / n,
        *[share(c) for c in "|#*%$&!.,"],
        len(tally) / count,
        max(tally.values(), default=0) / count,
        1.0 - len(set(lines)) / len(lines),
        count / len(lines),
        sum(len(line) < 20 for line in lines) / len(lines),
        sum(k for w, k in sample if not w[-1:].isalnum() and w[-1] < 128) / count,
        sum(k for w, k in sample if w.isupper()) / count,
    ]


@dataclass
class Trees:
    """Complete trees of one depth in heap order, flattened: node k has children 2k + 1 and 2k + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        raw, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            raw += leaf[node - inner]
        return 1.0 / (1.0 + np.exp(-raw))


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    inner = (1 << depth) - 1
    rate = float(np.average(y, weights=weight)) if len(y) else 0.5
    base = float(np.log(max(rate, 1e-6) / max(1 - rate, 1e-6)))
    empty = np.zeros((0, inner))
    if len(np.unique(y)) < 2:
        return Trees(base, empty.astype(np.int64), empty, np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    columns = x.shape[1]
    flat = binned + np.arange(columns) * BINS  # one cell for each column and bin
    raw = np.full(len(y), base)
    out = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-raw))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level
            cell = ((node - first)[:, None] * columns * BINS + flat).ravel()
            shape = (many, columns, BINS)
            hist = [np.bincount(cell, np.repeat(v, columns), many * columns * BINS).reshape(shape).cumsum(axis=2) for v in (g, h, weight)]
            gl, hl, wl = (a[:, :, :-1] for a in hist)
            ga, ha, wa = (a[:, :, -1:] for a in hist)
            gain = gl**2 / (hl + PENALTY) + (ga - gl) ** 2 / (ha - hl + PENALTY) - ga**2 / (ha + PENALTY)
            gain = np.where((wl >= LEAST_WEIGHT) & (wa - wl >= LEAST_WEIGHT), gain, -1.0)
            for j, c in enumerate(cuts):
                gain[:, j, len(c) :] = -1.0
            best = gain.reshape(many, -1).argmax(axis=1)
            for k in range(many):
                j, b = divmod(int(best[k]), BINS - 1)
                if gain[k, j, b] > 1e-9:
                    out.feature[t, first + k], out.limit[t, first + k] = j, cuts[j][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), out.feature[t, node]] > out.limit[t, node])
        leaf = node - inner
        sums = [np.bincount(leaf, v, inner + 1) for v in (g, h)]
        out.leaf[t] = RATE * sums[0] / (sums[1] + PENALTY)
        raw += out.leaf[t][leaf]
    return out


def _matrix(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(NAMES))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_label: int = SAMPLE_PER_LABEL,
) -> Trees:
    """Fit on at most about `per_label` documents of each label; `train` is a condition on `labels`."""
    chosen = F.broadcast(labelled_sample(labels, id_col, label_col, train, per_label))  # at most 2 x per_label rows
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("text")).join(chosen, "_id")

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame(
                {"id": frame["_id"], "x": list(_matrix(frame["text"])), "label": frame["label"], "weight": frame["weight"]}
            )

    def fit(frame: pd.DataFrame) -> Trees:
        x = np.stack(frame["x"].to_list())
        return fit_trees(x, frame["label"].to_numpy(np.float64), frame["weight"].to_numpy(np.float64))

    features = rows.mapInPandas(measure, "id long, x array<double>, label int, weight double")
    model = fit_in_one_task(features, ["id", "label"], fit)
    return model or fit_trees(np.zeros((0, len(NAMES))), np.zeros(0), np.zeros(0))


def score_quality(docs: DataFrame, model: Trees, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of `docs` as `_row`, and the score of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(_matrix(texts)))

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return packed.withColumn(name, score(F.col(f"_row.`{text_col}`")))
