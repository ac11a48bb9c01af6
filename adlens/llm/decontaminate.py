"""Benchmark passages in documents by a prefix-filtered set join.

An item is cut into windows of consecutive words. The shingles of a window are ordered by how rare they are
in the documents; since a document must contain all of them, the rarest one alone is the necessary prefix.
Documents are looked up by that shingle only, and the length and position of a hit bound where the window
could lie. Each candidate is then verified word by word over the window.

One pass over the documents splits them into words, counts the items' shingles and writes, for the few documents
that hold a shingle at all, their text; only those are searched. Ids stay with their rows in Arrow and are never
turned into floating-point numbers.

The index of the items is sent to the tasks in blocks of at most `block_windows` windows. Few items are
one block; more items are more passes over the documents, whose hits are merged per document. No result
depends on the number of blocks.

Defined cases: null and empty texts have no words; an item without words has no window; a repeated
`item_id` counts once; an item shorter than a window is one window; rows that repeat an id each get a row, and
so do rows without an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.bitmap import text_digest
from adlens.llm.memory import give_back
from adlens.sources.materialise import materialise

WINDOW = 10
SHINGLE = 5
BLOCK_WINDOWS = 1_000_000
#: Bytes of a word stand for themselves, A-Z for a-z; all others end a word.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Odd multiplier of the rolling hash; equal hashes are only candidates, words decide.
STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | bytes | None) -> list[bytes]:
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    return raw.translate(LETTERS).split()


def shingle_keys(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash for each `width` consecutive word ids."""
    n = len(ids) - width + 1
    keys = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        keys = keys * STEP + ids[k : k + n].astype(np.uint64) + np.uint64(1)
        keys ^= keys >> np.uint64(29)
    return keys


@dataclass
class Windows:
    """Windows of equal length: their words, items, and after `pick` the rarest shingle of each."""

    words: np.ndarray  # windows x length
    item: np.ndarray
    width: int
    key: np.ndarray | None = None
    offset: np.ndarray | None = None

    def shingles(self) -> np.ndarray:
        return np.stack([shingle_keys(row, self.width) for row in self.words])

    def pick(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Sort windows by their rarest shingle; of equally rare ones the first is taken."""
        all_keys = self.shingles()
        at = np.minimum(np.searchsorted(keys, all_keys), max(len(keys) - 1, 0))
        seen = np.where(keys[at] == all_keys, counts[at], 0) if len(keys) else np.zeros(all_keys.shape, np.int64)
        offset = seen.argmin(axis=1)
        key = all_keys[np.arange(len(all_keys)), offset]
        order = np.argsort(key, kind="stable")
        self.words, self.item, self.key, self.offset = self.words[order], self.item[order], key[order], offset[order]


@dataclass
class Index:
    ids: dict[bytes, int]  # word to number; 0 is any other word
    items: list
    groups: list[Windows]

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return numbers_of(self.ids, words)


def numbers_of(ids: dict[bytes, int], words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(ids.get, words, repeat(0)), np.int64, len(words))


def build_index(items: pd.DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> Index:
    ids: dict[bytes, int] = {}
    by_length: dict[int, list] = {}
    names = []
    for name, text in zip(items["item_id"], items["text"], strict=True):
        numbers = np.array([ids.setdefault(w, len(ids) + 1) for w in words_of(text)], np.int64)
        if not len(numbers):
            continue
        length = min(window, len(numbers))
        windows = np.lib.stride_tricks.sliding_window_view(numbers, length)
        by_length.setdefault(length, []).append((windows, np.full(len(windows), len(names))))
        names.append(name)
    groups = [
        Windows(np.concatenate([w for w, _ in parts]), np.concatenate([i for _, i in parts]), min(shingle, length))
        for length, parts in sorted(by_length.items())
    ]
    return Index(ids, names, groups)


def find(index: Index, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the hit stretches (merged, in order) and the numbers of the items that occur."""
    ids, n = index.numbers(words), len(words)
    edges, found = np.zeros(n + 1, np.int64), []
    keys: dict[int, np.ndarray] = {}
    known = ids > 0
    for group in index.groups:
        length = group.words.shape[1]
        if n < length:  # length bound
            continue
        if group.width not in keys:
            keys[group.width] = shingle_keys(ids, group.width)
        own = keys[group.width]
        at = np.flatnonzero(known[: len(own)] & known[group.width - 1 :])
        first = np.searchsorted(group.key, own[at], "left")
        many = np.searchsorted(group.key, own[at], "right") - first
        at, first, many = at[many > 0], first[many > 0], many[many > 0]
        # candidates in slices: a frequent shingle of many windows does not fill the memory
        for lo in range(0, len(at), 4096):
            a, f, m = at[lo : lo + 4096], first[lo : lo + 4096], many[lo : lo + 4096]
            which = np.repeat(f, m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            start = np.repeat(a, m) - group.offset[which]
            fits = (start >= 0) & (start + length <= n)  # positional bound
            start, which = start[fits], which[fits]
            same = (ids[start[:, None] + np.arange(length)] == group.words[which]).all(axis=1)
            start, which = start[same], which[same]
            np.add.at(edges, start, 1)
            np.add.at(edges, start + length, -1)
            found.append(group.item[which])
    hit = np.cumsum(edges[:-1]) > 0
    step = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    spans = np.stack([np.flatnonzero(step == 1), np.flatnonzero(step == -1)], axis=1)
    return spans, np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


WRITTEN = "_id long, _digest string, n_words long, text string, w long, at long, n long"


def _first_pass(rows: DataFrame, shared: Broadcast) -> DataFrame:
    """A row per document - with its text only if it holds a shingle of an item - and the counts of the shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wanted = shared.value
        sums = {w: np.zeros(len(k), np.int64) for w, k in wanted.items()}
        for batch in batches:
            sizes, holds = [], []
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                words = words_of(raw)
                numbers, holding = numbers_of(ids, words), False
                known = numbers > 0
                for w, keys in wanted.items():
                    if len(words) < w or not len(keys):
                        continue
                    at = np.flatnonzero(known[: len(known) - w + 1] & known[w - 1 :])
                    if not len(at):
                        continue
                    own = shingle_keys(numbers, w)[at]
                    place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                    place = place[keys[place] == own]
                    holding |= len(place) > 0
                    np.add.at(sums[w], place, 1)
                sizes.append(len(words))
                holds.append(holding)
            none = pa.nulls(len(sizes), pa.int64())
            text = pa.compute.if_else(pa.array(holds, pa.bool_()), batch.column("text"), pa.scalar(None, pa.string()))
            yield _written(batch.column("_id"), batch.column("_digest"), pa.array(sizes, pa.int64()), text, none, none, none)
        for w, total in sums.items():
            at = np.flatnonzero(total)
            none, nothing = pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.string())
            yield _written(none, nothing, none, nothing, pa.array(np.full(len(at), w)), pa.array(at), pa.array(total[at]))
        give_back()

    return rows.mapInArrow(run, WRITTEN)


def _written(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), ["_id", "_digest", "n_words", "text", "w", "at", "n"])


def _hits(rows: DataFrame, index: Index) -> DataFrame:
    """`_id`, `_digest`, `n_words`, `starts`, `ends`, `items` of every row, written."""
    context = rows.sparkSession.sparkContext
    widths: dict[int, np.ndarray] = {}
    for group in index.groups:
        widths[group.width] = np.union1d(widths.get(group.width, np.zeros(0, np.uint64)), group.shingles().ravel())
    shared = context.broadcast((index.ids, widths))
    written = materialise(_first_pass(rows, shared), "words")
    shared.destroy()
    counts = {w: np.zeros(len(k), np.int64) for w, k in widths.items()}
    counted = written.filter("w IS NOT NULL").groupBy("w", "at").agg(F.sum("n").alias("n"))
    for w, at, n in counted.collect():  # at most one row for each shingle of the block
        counts[w][at] = n
    for group in index.groups:
        group.pick(widths[group.width], counts[group.width])
    whole = context.broadcast(index)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = whole.value
        for batch in batches:
            starts, ends, items = [], [], []
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                spans, found = find(own, words_of(raw))
                starts.append(spans[:, 0].tolist())
                ends.append(spans[:, 1].tolist())
                items.append([own.items[i] for i in found])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (starts, ends, items)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], ["_id", "_digest", "n_words", "starts", "ends", "items"])

    schema = "_id long, _digest string, n_words long, starts array<long>, ends array<long>, items array<long>"
    rows = written.filter("n_words IS NOT NULL").select("_id", "_digest", "n_words", "text")
    found = rows.filter("text IS NOT NULL").mapInArrow(search, schema)
    nothing = F.array().cast("array<long>")
    others = rows.filter("text IS NULL").select(
        "_id", "_digest", "n_words", *[nothing.alias(c) for c in ("starts", "ends", "items")]
    )
    hits = materialise(found.unionByName(others), "hits")
    whole.destroy()
    return hits


def _merge(parts: list[DataFrame]) -> DataFrame:
    """Hits of several blocks for the same documents; equal rows have equal hits and stay as many as they were."""
    every = parts[0].withColumn("_block", F.lit(0))
    for k, part in enumerate(parts[1:], 1):
        every = every.unionByName(part.withColumn("_block", F.lit(k)))
    grouped = every.groupBy("_id", "_digest", "_block").agg(
        F.count("*").alias("_copies"),
        *[F.first(c).alias(c) for c in ("n_words", "starts", "ends", "items")],
    )
    spans = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))))
    merged = grouped.groupBy("_id", "_digest").agg(
        F.max("_copies").cast("int").alias("_copies"),
        F.max("n_words").alias("n_words"),
        spans.alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    return merged.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_windows: int = BLOCK_WINDOWS,
    with_digest: bool = False,
) -> DataFrame:
    """`id`, `n_words`, `n_hit`, `items` (ids of items with occurring windows) for every row of `docs`, and on request
    the `digest` of its text."""
    listed = items.select(
        F.col(f"`{item_id_col}`").cast("long").alias("item_id"), F.coalesce(F.col(f"`{item_text_col}`"), F.lit("")).alias("text")
    ).distinct()
    size = listed.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 2 + 1  # at least the number of words
    blocks = -(-size // block_windows)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        (text_digest(F.col(f"`{text_col}`")) if blocks > 1 or with_digest else F.lit(None).cast("string")).alias("_digest"),
    )
    parts = []
    for k in range(blocks):
        # the texts of one block hold at most about `block_windows` words
        block = listed.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        frame = pd.DataFrame([tuple(r) for r in block], columns=["item_id", "text"], dtype=object)
        parts.append(_hits(rows, build_index(frame, window, shingle)))
    if blocks == 1:
        merged = parts[0].withColumn("spans", F.arrays_zip("starts", "ends")).withColumn("items", F.array_distinct("items"))
    else:
        merged = _merge(parts)
    # spans come in order, so each adds what lies beyond the furthest end so far
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["ends"] - F.greatest(s["starts"], acc["to"]))).alias("n"),
            F.greatest(acc["to"], s["ends"]).alias("to"),
        ),
    )
    digest = [F.col("_digest").alias("digest")] if with_digest else []
    return merged.select(F.col("_id").alias("id"), "n_words", covered["n"].alias("n_hit"), "items", *digest)
