"""SimHash near-duplicates found by covering locality-sensitive hashing.

Fingerprint: each bit is the majority of that bit over the 64-bit hashes of a text's word shingles. Equal
fingerprints are first merged, so copies cost nothing. Every bit position gets a vector of radius + 1
bits; table v keeps the positions whose vector has odd parity with v. For any `radius` positions some v is
orthogonal to all their vectors, so two fingerprints that differ there agree in table v: every pair within
the radius meets in one of the 2^(radius+1) - 1 tables. Whoever meets is compared exactly.

A bucket gives back at most one link a member (a spanning forest of its close pairs), not its pairs.
Buckets of more than `bucket_rows` different fingerprints take another exact way that is linear in the
members: x and y differ in at most three bits if and only if some z lies within one flip of x and two of
y, so all within two flips of z are linked to one fingerprint within one flip of z.

Defined cases: null and empty texts have fingerprint zero and link like others; rows that repeat an id
each get a result; rows with a null id take part and their component is the smallest id that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.bitmap import text_digest
from adlens.llm.components import components
from adlens.llm.memory import give_back
from adlens.sources.materialise import materialise

RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
BUCKET_ROWS = 20_000
CHUNK = 1 << 18


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint; A-Z lower-cased, words split at ASCII white space."""
    # bytes.lower and bytes.split know exactly A-Z and the six ASCII white space characters
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    body = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(words, len(parts))
    starts, ends = starts[: len(parts) - width + 1], ends[width - 1 :]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for lo in range(0, len(starts), CHUNK):
        pairs = zip(starts[lo : lo + CHUNK].tolist(), ends[lo : lo + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(body[s:e], SEED) for s, e in pairs], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """`id`, `digest` (of the text), `fp` (the fingerprint as a signed long) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # ids stay in Arrow: a null among them changes no other id
            prints = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            columns = [batch.column(0), batch.column(2), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "digest", "fp"])
        give_back()

    text = F.col(f"`{text_col}`")
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), text_digest(text).alias("digest"))
    return narrow.mapInArrow(run, "id long, digest string, fp long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """Bit masks of the tables; position i has the non-zero vector 1 + i mod (2^(radius+1) - 1)."""
    tables = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(64) if ((1 + i % tables) & v).bit_count() & 1) for v in range(1, tables + 1)
    ]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 the smallest node of their component."""
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        open_ = a != b
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    return root


def bucket_links(bucket: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the close pairs within buckets; rows come sorted by bucket."""
    n, lefts, rights, held = len(prints), [], [], 0
    root = np.arange(n)
    last = np.searchsorted(bucket, bucket, side="right")  # one past the bucket of each row
    rows, lag = np.arange(n), 1
    while len(rows := rows[rows + lag < last[rows]]):
        close = np.bitwise_count(prints[rows] ^ prints[rows + lag]) <= radius
        near = rows[close]
        differ = root[near] != root[near + lag]
        lefts.append(near[differ])
        rights.append(near[differ] + lag)
        held += int(differ.sum())
        if held > n:  # merge now, so that pairs already connected are no longer kept
            joined = _forest(root[np.concatenate(lefts)], root[np.concatenate(rights)], n)
            root, lefts, rights, held = joined[root], [], [], 0
        lag += 1
    if lefts:
        root = _forest(root[np.concatenate(lefts)], root[np.concatenate(rights)], n)[root]
    moved = np.flatnonzero(root != np.arange(n))
    return prints[moved], prints[root[moved]]


def _small_bucket_links(members: DataFrame, radius: int) -> DataFrame:
    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = pd.DataFrame({"t": [], "key": [], "fp": []}, dtype=np.int64)
        for frame in frames:
            frame = pd.concat([rest, frame], ignore_index=True)
            t, key = frame["t"].to_numpy(), frame["key"].to_numpy()
            change = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            cut = int(change[-1]) if len(change) else 0
            rest = frame.iloc[cut:]
            if cut:
                yield links(frame.iloc[:cut])
        if len(rest):
            yield links(rest)

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        t, key = frame["t"].to_numpy(), frame["key"].to_numpy()
        bucket = np.concatenate([[0], np.cumsum((t[1:] != t[:-1]) | (key[1:] != key[:-1]))])
        a, b = bucket_links(bucket, frame["fp"].to_numpy().view(np.uint64), radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = members.repartition("t", "key").sortWithinPartitions("t", "key")
    return dealt.mapInPandas(batches, "a long, b long")


def _large_bucket_links(members: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Links through points z of the cube: one flip on one side, the others on the other (radius 3: 1 and 2)."""
    near, far = radius // 2, radius - radius // 2
    free = [[i for i in range(64) if not mask >> i & 1] for mask in masks]

    def flips(frames: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for t, part in frame.groupby("t"):
                bits = np.array([1 << i for i in free[t]], dtype=np.uint64)
                patterns = reach = np.zeros(1, np.uint64)
                for _ in range(most):
                    reach = np.unique((reach[:, None] ^ bits[None, :]).ravel())
                    patterns = np.union1d(patterns, reach)
                prints = part["fp"].to_numpy().view(np.uint64)
                for lo in range(0, len(prints), 512):
                    some = prints[lo : lo + 512]
                    yield pd.DataFrame(
                        {
                            "t": np.int64(t),
                            "z": (some[:, None] ^ patterns[None, :]).ravel().view(np.int64),
                            "fp": np.repeat(some, len(patterns)).view(np.int64),
                        }
                    )

    schema, rows = "t long, z long, fp long", members.select("t", "fp")
    anchors = (
        rows.mapInPandas(lambda frames: flips(frames, near), schema).groupBy("t", "z").agg(F.min("fp").alias("b"))
    )
    reached = rows.mapInPandas(lambda frames: flips(frames, far), schema)
    return reached.join(anchors, ["t", "z"]).filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def close_links(prints: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links `a`, `b` whose components are those of all pairs of different `fp` within `radius` bits."""
    masks = covering_masks(radius)
    tables = F.array(
        *[
            F.struct(F.lit(t).cast("long").alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for t, m in enumerate(masks)
        ]
    )
    members = prints.select("fp", F.explode(tables).alias("at")).select("at.t", "at.key", "fp")
    sizes = materialise(members.groupBy("t", "key").count().filter("count > 1"), "buckets")
    shared = members.join(sizes, ["t", "key"])
    small = _small_bucket_links(shared.filter(F.col("count") <= bucket_rows).select("t", "key", "fp"), radius)
    large = sizes.filter(F.col("count") > bucket_rows).drop("count")
    if large.isEmpty():
        return small
    return small.unionByName(_large_bucket_links(members.join(large, ["t", "key"], "left_semi"), masks, radius))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """`id`, `digest`, `fp`, `component_id` (the smallest id that links reach), `root` (the component's smallest
    fingerprint) for every row of `docs`."""
    rows = materialise(fingerprints(docs, id_col, text_col, words), "prints")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(close_links(nodes.select("fp"), radius, bucket_rows))
    placed = materialise(
        nodes.join(roots, F.col("fp") == F.col("a"), "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        "placed",
    )
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(placed.join(names, "root").select("fp", "component_id", "root"), "fp")


def surplus(found: DataFrame) -> DataFrame:
    """`id`, `digest` of the rows of `near_duplicates` that go if one of each group stays.

    The one with the smallest id stays, ids before nulls, of equal ids the one with the smallest digest. Rows equal in
    id and text are one document: they stay or go together.
    """
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "digest")
    placed = found.select("root", "id", "digest", place.alias("place"))
    first = materialise(placed.groupBy("root").agg(F.min("place").alias("first")), "firsts")
    return placed.join(first, "root").filter(~F.col("place").eqNullSafe(F.col("first"))).select("id", "digest")
