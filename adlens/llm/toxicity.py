"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A text is the bag of its different character n-grams (3 to 6 characters inside a word and its borders),
hashed into buckets. The vocabulary is every bucket whose share of documents differs clearly between the
labels. The embeddings of the vocabulary's n-grams in a text are averaged (together with `PRIOR` zero
vectors, so that one n-gram alone decides little) and go through a linear layer and a softmax of two
classes. A misspelt or inflected word never seen before still shares most of its n-grams with a known one.
Embeddings and layer are trained together on a bounded sample of labelled rows (`SAMPLE_PER_LABEL` ids of
each label), in one task. With two classes the logit is the average of one number per bucket, so that
scoring is a lookup per n-gram.

Defined cases: null and empty texts have no n-grams and get the score of the bias; with no labelled rows or
one label only, every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.sampling import fit_in_one_task, labelled_sample

SAMPLE_PER_LABEL = 1_500
BITS = 18
SIZES = (3, 4, 5, 6)
DIMENSIONS, ROUNDS, RATE, PENALTY = 4, 500, 0.05, 1e-3
#: Standard deviations by which a bucket's share of documents must differ between the labels.
CLEAR = 4.0
PRIOR = 10.0
#: The average is of small shares; this keeps the embeddings of ordinary size.
SCALE = 10.0
CHUNK = 1 << 20
_STEP, _MIX = np.uint32(0x01000193), np.uint32(0x9E3779B1)

_BORDER = np.zeros(0x3100, bool)
_BORDER[:128] = [not chr(c).isalnum() for c in range(128)]
for _lo, _hi in ((0xA0, 0xBF), (0x2000, 0x206F), (0x3000, 0x303F)):
    _BORDER[_lo : _hi + 1] = True


def _codes(text: str | None) -> np.ndarray:
    """Code points, lower-cased, with each stretch between words as one 0; a 0 at either end."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    border = _BORDER[np.minimum(raw, len(_BORDER) - 1)] & (raw < len(_BORDER))
    codes = np.concatenate([[np.uint32(0)], np.where(border, np.uint32(0), raw), [np.uint32(0)]]).astype(np.uint32)
    return codes[(codes != 0) | np.concatenate([[True], codes[:-1] != 0])]


def _ngrams(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: where an n-gram starts, and its bucket."""
    word = codes != 0
    keys, inside = codes * _STEP, np.ones(len(codes), bool)
    for size in range(2, SIZES[-1] + 1):
        n = len(codes) - size + 1
        if n <= 0:
            return
        keys = (keys[:n] ^ codes[size - 1 :]) * _STEP
        inside = inside[:n] & word[size - 2 : size - 2 + n] if size > 2 else inside[:n]
        if size in SIZES:
            at = np.flatnonzero(inside)
            yield at, ((keys[at] + np.uint32(size)) * _MIX) >> np.uint32(32 - BITS)


def bag(text: str | None) -> np.ndarray:
    """The different buckets of a text."""
    found = [b for _, b in _ngrams(_codes(text))]
    return np.unique(np.concatenate(found)).astype(np.int64) if found else np.zeros(0, np.int64)


@dataclass
class Softmax:
    weight: np.ndarray  # by bucket: its embedding times the difference of the two rows of the layer
    bias: float

    def score(self, texts) -> np.ndarray:
        totals, counts = [], []
        held: list[np.ndarray] = []
        size = 0
        for text in [*texts, None]:
            if held and (text is None or size > CHUNK):
                a, b = self._sums(held)
                totals.append(a)
                counts.append(b)
                held, size = [], 0
            if text is not None:
                held.append(_codes(text))
                size += len(held[-1])
        total = np.concatenate(totals) if totals else np.zeros(0)
        count = np.concatenate(counts) if counts else np.zeros(0)
        return 1.0 / (1.0 + np.exp(-np.clip(self.bias + SCALE * total / count, -50, 50)))

    def _sums(self, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([len(x) for x in held])
        codes, found = np.concatenate(held), [np.zeros(0, np.int64)]
        known = self.weight != 0
        for at, buckets in _ngrams(codes):
            # two zeros meet where texts meet, so no n-gram crosses from one to the next
            own = np.flatnonzero(known[buckets])
            found.append(np.searchsorted(ends, at[own], "right") << BITS | buckets[own].astype(np.int64))
        cells = np.unique(np.concatenate(found))
        text = cells >> BITS
        total = np.bincount(text, self.weight[cells & ((1 << BITS) - 1)], len(held))
        return total, np.bincount(text, minlength=len(held)) + PRIOR


def fit_softmax(bags: list[np.ndarray], label: np.ndarray, weight: np.ndarray) -> Softmax:
    rate = float(np.average(label, weights=weight)) if len(label) else 0.5
    bias = float(np.log(max(rate, 1e-6) / max(1 - rate, 1e-6)))
    if len(np.unique(label)) < 2:
        return Softmax(np.zeros(1 << BITS, np.float32), bias)
    doc, bucket = np.repeat(np.arange(len(bags)), [len(b) for b in bags]), np.concatenate(bags)
    ones, n1, n0 = label[doc] == 1, (label == 1).sum(), (label == 0).sum()
    f1, f0 = (np.bincount(bucket[m], minlength=1 << BITS) for m in (ones, ~ones))
    pooled = (f1 + f0 + 1.0) / (n1 + n0 + 2.0)
    clear = np.abs(f1 / n1 - f0 / n0) >= CLEAR * np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))
    doc, bucket = doc[clear[bucket]], bucket[clear[bucket]]
    if not len(doc):
        return Softmax(np.zeros(1 << BITS, np.float32), bias)
    share = (SCALE / (np.bincount(doc, minlength=len(bags)) + PRIOR))[doc]
    used, column = np.unique(bucket, return_inverse=True)
    # classes weigh the same while training; the bias is set back to the true shares afterwards
    balance = np.where(label == 1, weight / weight[label == 1].sum(), weight / weight[label == 0].sum()) / 2
    rng = np.random.default_rng(7)
    embed = rng.normal(0, 0.05, (len(used), DIMENSIONS)).astype(np.float32)
    layer, b = rng.normal(0, 0.5, DIMENSIONS), 0.0
    by_column = np.argsort(column, kind="stable")
    column_doc, column_share = doc[by_column], share[by_column].astype(np.float32)
    share = share.astype(np.float32)
    starts = np.searchsorted(column[by_column], np.arange(len(used)))
    doc_starts = np.searchsorted(doc, np.arange(len(bags)))
    full = np.diff(np.append(doc_starts, len(doc))) > 0
    moments, squares = [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]
    for step in range(1, ROUNDS + 1):
        logit = np.full(len(bags), b)
        logit[full] += np.add.reduceat(share * (embed @ layer).astype(np.float32)[column], doc_starts[full])
        p = 1.0 / (1.0 + np.exp(-np.clip(logit, -50, 50)))
        error = balance * (p - label)
        # how far each bucket pulls the logits; the layer's gradient is the same pull seen through the embeddings
        pull = np.add.reduceat(column_share * error.astype(np.float32)[column_doc], starts)
        grads = [pull[:, None] * layer[None, :] + PENALTY * embed / len(used), embed.T @ pull, error.sum()]
        moves = []
        for k, grad in enumerate(grads):
            # one scale for all embeddings: buckets with a steady pull move most
            moments[k] = 0.9 * moments[k] + 0.1 * grad
            squares[k] = 0.95 * squares[k] + 0.05 * float(np.max(np.abs(grad))) ** 2
            moves.append(RATE * moments[k] / (np.sqrt(squares[k] / (1 - 0.95**step)) + 1e-12))
        embed -= moves[0].astype(np.float32)
        layer -= moves[1]
        b -= float(moves[2])
    out = np.zeros(1 << BITS, np.float32)
    out[used] = embed @ layer
    return Softmax(out, b + bias)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_label: int = SAMPLE_PER_LABEL,
) -> Softmax:
    """Fit on at most about `per_label` documents of each label; `train` is a condition on `labels`."""
    chosen = F.broadcast(labelled_sample(labels, id_col, label_col, train, per_label))  # at most 2 x per_label rows
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("text")).join(chosen, "_id")

    def bags(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame(
                {
                    "id": frame["_id"],
                    "buckets": [bag(t).astype(np.int32) for t in frame["text"]],
                    "label": frame["label"],
                    "weight": frame["weight"],
                }
            )

    def fit(frame: pd.DataFrame) -> Softmax:
        own = [np.asarray(b, np.int64) for b in frame["buckets"]]
        return fit_softmax(own, frame["label"].to_numpy(np.float64), frame["weight"].to_numpy(np.float64))

    features = rows.mapInPandas(bags, "id long, buckets array<int>, label int, weight double")
    return fit_in_one_task(features, ["id", "label"], fit) or fit_softmax([], np.zeros(0), np.zeros(0))


def score_toxicity(docs: DataFrame, model: Softmax, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of `docs` as `_row`, and the score of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(texts.fillna("")))

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return packed.withColumn(name, score(F.col(f"_row.`{text_col}`")))
