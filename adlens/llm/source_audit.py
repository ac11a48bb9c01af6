"""How the sources of a language differ in their words, with terms moved as digests.

Each task counts the terms of its documents by (language, source) and writes, once per term, the text, a 64-bit
digest and the counts. Everything shuffled from there on names a term by its digest alone. Texts are read twice
more: for digests frequent enough to matter, their smallest and largest text are found - where the two differ,
different terms share a digest, and just those digests are split by text; and the texts of the rows that are
returned are joined back at the very end.

Frequencies are whole numbers: p = 1 + floor(unit * (count + 5) / (N + 5 * V)), divided in three steps of a thousand
so that nothing overflows below N of about 9 * 10**15. Sources are compared in blocks: a task holds a block of terms
for two tiles of sources as a matrix and adds up the absolute differences of its pairs, so a language with many
sources or terms is many tasks, and nothing is emitted per pair and term.

Defined cases: null text, language and source are empty strings; a group without terms, or a language without kept
terms, still has its pairs (value 0 without kept terms) and no terms; a language with one source has no pairs; equal
values rank by the bytes of the item; repeated rows count as often as they stand; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.bitmap import bitmap_of, with_hint
from adlens.sources.materialise import materialise

LEAST_DOCS, TOP_TERMS = 30, 50
UNIT, PRIOR = 1_000_000_000, 5
#: A block has as many terms as the language has sources, within these bounds: pairs of sources are sent once a block.
LEAST_BLOCK, MOST_BLOCK, TILE_SOURCES = 512, 4096, 256
#: A task writes out and forgets its counts at so many terms or (group, term) pairs.
MOST_TERMS, MOST_COUNTS = 400_000, 2_000_000
#: Documents whose words are counted together, at most, and the words at which a batch of them ends.
BATCH_DOCS, BATCH_WORDS = 4096, 2_000_000

#: Bytes of a term stand for themselves, A-Z for a-z; all others end a term.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
PARTIAL = "term string, counts array<struct<lang:string,source:string,n:bigint,docs:bigint>>"


class _Numbers(dict):
    """Numbers the keys it is asked for."""

    def __missing__(self, key: object) -> int:
        self[key] = number = len(self)
        return number


class TermCounter:
    """Counts of terms by group, for the documents of one task."""

    def __init__(self) -> None:
        self.groups, self.terms = _Numbers(), _Numbers()
        self.words: list[np.ndarray] = []
        self.owners: list[int] = []
        self.waiting = 0
        self.keys, self.n, self.docs = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, group: tuple[str, str], text: bytes) -> None:
        words = text.translate(LETTERS).split()
        ids = np.fromiter(map(self.terms.__getitem__, words), np.int64, len(words))
        ids |= len(self.owners) << 32
        self.owners.append(self.groups[group])
        self.words.append(ids)
        self.waiting += len(words)
        if len(self.owners) == BATCH_DOCS or self.waiting > BATCH_WORDS:
            self.count()

    def count(self) -> None:
        if not self.owners:
            return
        pairs, times = np.unique(np.concatenate(self.words), return_counts=True)
        owner = np.array(self.owners, np.int64)[pairs >> 32]
        keys = np.concatenate([self.keys, (pairs & 0xFFFFFFFF) << 32 | owner])
        n, docs = np.concatenate([self.n, times]), np.concatenate([self.docs, np.ones(len(pairs), np.int64)])
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        self.keys = keys[starts]
        self.n, self.docs = (np.add.reduceat(v[order], starts) if len(starts) else v for v in (n, docs))
        self.words, self.owners, self.waiting = [], [], 0

    def full(self) -> bool:
        return len(self.terms) > MOST_TERMS or len(self.keys) > MOST_COUNTS

    def drain(self) -> Iterator[pa.RecordBatch]:
        """A row per term, and one without a term that names all groups; then forget everything."""
        self.count()
        langs, sources = (pa.array([g[i] for g in self.groups], pa.string()) for i in (0, 1))
        names = pa.array([*self.terms], pa.binary()).cast(pa.string())
        term, owner = self.keys >> 32, self.keys & 0xFFFFFFFF
        starts = np.flatnonzero(np.diff(term, prepend=-1))
        bounds = np.append(starts, len(term))
        for a in range(0, len(starts), 20_000):
            b = min(a + 20_000, len(starts))
            yield _rows(names.take(pa.array(term[starts[a:b]])), bounds[a : b + 1], owner, self.n, self.docs, langs, sources)
        if self.groups:
            zero = np.zeros(len(self.groups), np.int64)
            yield _rows(pa.nulls(1, pa.string()), np.array([0, len(zero)]), np.arange(len(zero)), zero, zero, langs, sources)
        self.__init__()


def _rows(names, bounds, owner, n, docs, langs, sources) -> pa.RecordBatch:
    cut = slice(bounds[0], bounds[-1])
    at = pa.array(owner[cut])
    counts = pa.StructArray.from_arrays(
        [langs.take(at), sources.take(at), pa.array(n[cut]), pa.array(docs[cut])], ["lang", "source", "n", "docs"]
    )
    lists = pa.ListArray.from_arrays(pa.array((bounds - bounds[0]).astype(np.int32)), counts)
    return pa.RecordBatch.from_arrays([names, lists], ["term", "counts"])


def count_terms(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """`term`, `counts` (lang, source, n, docs) as each task finds them, and rows without a term that name groups."""
    rows = docs.select(
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "l"), (source_col, "s"), (text_col, "t"))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter()
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                counter.add((lang, source), text)
                if counter.full():
                    yield from counter.drain()
        yield from counter.drain()

    return rows.mapInArrow(run, PARTIAL)


def exact_share(count: Column, total: Column, terms: Column, unit: int = UNIT, prior: int = PRIOR) -> Column:
    """1 + floor(unit * (count + prior) / (total + prior * terms)) in longs; `unit` is a power of a thousand."""
    whole, rest, left = F.lit(0).cast("long"), count + prior, unit
    below = total + prior * terms
    while left > 1:
        rest, left = rest * 1000, left // 1000
        whole = whole * 1000 + F.call_function("div", rest, below)
        rest = rest % below
    return whole + 1


def _share(counts: np.ndarray, below: np.ndarray, unit: int, prior: int) -> np.ndarray:
    whole, rest = np.zeros_like(counts), counts + prior
    while unit > 1:
        rest, unit = rest * 1000, unit // 1000
        whole = whole * 1000 + rest // below
        rest %= below
    return whole + 1


def _differences(unit: int, prior: int):
    """Sum over the terms of a block of the absolute differences, for the pairs of sources of two tiles."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lang, _, a, b = (k.as_py() for k in key)
        heads = table.filter(pa.compute.is_null(table["digest"]))
        names, tiles = heads["source"].to_pylist(), heads["tile"].to_numpy()
        order = sorted(range(len(names)), key=lambda i: names[i].encode())
        names, tiles = [names[i] for i in order], tiles[order]
        below = (heads["total"].to_numpy() + prior * heads["terms"].to_numpy())[order]
        body = table.filter(pa.compute.is_valid(table["digest"]))
        at = {s: i for i, s in enumerate(names)}
        lines = np.fromiter((at[s] for s in body["source"].to_pylist()), np.int64, body.num_rows)
        keys = body.select(["digest", "split"]).to_pandas()
        columns = keys.groupby(["digest", "split"], sort=False).ngroup().to_numpy() if len(keys) else np.zeros(0, np.int64)
        counts = np.zeros((len(names), int(columns.max(initial=-1)) + 1), np.int64)
        counts[lines, columns] = body["n"].to_numpy()
        below = np.maximum(below, 1)[:, None]
        shares, never = _share(counts, below, unit, prior), _share(np.zeros_like(below), below, unit, prior)[:, 0]
        # Terms of the block that none of these sources has are counted, not listed.
        others_have = int(heads["block_terms"][0].as_py()) - counts.shape[1]
        out: list[tuple[str, str, int]] = []
        for i, name in enumerate(names):
            others = np.arange(i + 1, len(names))
            if a != b:  # pairs within a tile are another task's
                others = others[tiles[others] != tiles[i]]
            sums = np.abs(shares[others] - shares[i]).sum(axis=1) + others_have * np.abs(never[others] - never[i])
            out += [(name, names[j], int(v)) for j, v in zip(others, sums, strict=True)]
        return pa.table(
            {
                "lang": pa.array([lang] * len(out), pa.string()),
                "x": pa.array([o[0] for o in out], pa.string()),
                "y": pa.array([o[1] for o in out], pa.string()),
                "value": pa.array([o[2] for o in out], pa.int64()),
            }
        )

    return run


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS,
    unit: int = UNIT,
    prior: int = PRIOR,
    digest=F.xxhash64,
    least_block: int = LEAST_BLOCK,
    most_block: int = MOST_BLOCK,
    tile_sources: int = TILE_SOURCES,
) -> DataFrame:
    """`lang`, `source`, `part` (pair or term), `item`, `value`, `rank`.

    `pair`: the other sources of the language by the sum of |p - q| over the kept terms, q the other's share.
    `term`: the `top` kept terms that the source has by p - q where positive, q the share in the whole language.
    Kept are terms in at least `least_docs` documents of the language. `digest` may be any function of a column
    that returns a long; results do not depend on it.
    """
    found = materialise(
        count_terms(docs, text_col, lang_col, source_col).select(
            F.when(F.col("term").isNotNull(), digest("term")).alias("digest"), "term", "counts"
        ),
        "term_counts",
    )
    groups = found.filter("digest IS NULL").select(F.inline("counts")).select("lang", "source").distinct()
    terms = found.filter("digest IS NOT NULL")

    # Digests that may be kept, by language: no fewer documents than any of their terms has.
    may = materialise(
        terms.select("digest", F.inline("counts"))
        .groupBy("lang", "digest")
        .agg(F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= least_docs)
        .select("lang", "digest"),
        "digests",
    )
    hinted = with_hint(terms, [F.col("digest")], bitmap_of(may, [F.col("digest")]), "hint").filter("hint").drop("hint")
    texts = materialise(
        hinted.groupBy("digest", "term").agg(F.lit(1).alias("one"))
        .groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")),
        "texts",
    )
    split = materialise(texts.filter("low <> high").select("digest"), "collisions")

    # Counts by group, where `split` is empty but for terms that share a digest.
    marked = hinted.join(split.withColumn("shared", F.lit(True)), "digest", "left")
    counts = materialise(
        marked.select(
            "digest", F.when(F.col("shared"), F.col("term")).otherwise("").alias("split"), F.inline("counts")
        )
        .groupBy("lang", "source", "digest", "split")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "group_counts",
    )
    kept = materialise(
        counts.groupBy("lang", "digest", "split")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= least_docs)
        .drop("docs"),
        "kept_terms",
    )
    own = materialise(
        counts.drop("docs").join(kept, ["lang", "digest", "split"]), "kept_counts"
    )  # lang, digest, split, source, n, lang_n
    whole = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    sums = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    zero = {"total": 0, "terms": 0, "lang_total": 0}
    known = materialise(
        groups.join(sums, ["lang", "source"], "left").join(whole, "lang", "left").join(sources, "lang").fillna(zero)
        .withColumn("block_size", F.least(F.lit(most_block), F.greatest(F.lit(least_block), F.col("sources"))))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("terms") / F.col("block_size"))).cast("long"))
        .withColumn("tiles", F.ceil(F.col("sources") / tile_sources).cast("long"))
        .withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles"))),
        "groups",
    )
    return _pairs(own, kept, known, unit, prior).unionByName(_terms(own, known, texts, top, unit, prior))


def _pairs(own: DataFrame, kept: DataFrame, known: DataFrame, unit: int, prior: int) -> DataFrame:
    langs = known.select("lang", "blocks").distinct()
    block = F.pmod(F.xxhash64("digest", "split"), F.col("blocks")).alias("block")
    sizes = (
        kept.join(langs, "lang").groupBy("lang", block).agg(F.count("*").alias("block_terms"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    low, high = F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b")
    nothing = F.lit(None).cast("long")
    heads = (
        known.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
        .join(sizes, ["lang", "block"], "left")
        .fillna({"block_terms": 0})
        .select("*", other)
        .select(
            "lang", "block", low, high, "source", "tile", "total", "terms", "block_terms",
            nothing.alias("digest"), F.lit("").alias("split"), nothing.alias("n"),
        )
    )
    body = (
        own.join(known.select("lang", "source", "blocks", "tiles", "tile"), ["lang", "source"])
        .select("lang", block, "tile", "source", "digest", "split", "n", other)
        .select(
            "lang", "block", low, high, "source", "tile", nothing.alias("total"), nothing.alias("terms"),
            nothing.alias("block_terms"), "digest", "split", "n",
        )
    )
    sums = (
        heads.unionByName(body)
        .groupBy("lang", "block", "a", "b")
        .applyInArrow(_differences(unit, prior), "lang string, x string, y string, value long")
        .groupBy("lang", "x", "y")
        .agg(F.sum("value").alias("value"))
    )
    ways = F.explode(
        F.array(
            F.struct(F.col("x").alias("source"), F.col("y").alias("item")),
            F.struct(F.col("y").alias("source"), F.col("x").alias("item")),
        )
    ).alias("way")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return (
        sums.select("lang", "value", ways)
        .select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")
        .withColumn("rank", F.row_number().over(order))
    )


def _terms(own: DataFrame, known: DataFrame, texts: DataFrame, top: int, unit: int, prior: int) -> DataFrame:
    joined = own.filter("n > 0").join(known.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
    p = exact_share(F.col("n"), F.col("total"), F.col("terms"), unit, prior)
    q = exact_share(F.col("lang_n"), F.col("lang_total"), F.col("terms"), unit, prior)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    first = (
        joined.select("lang", "source", "digest", "split", (p - q).alias("value"))
        .filter("value > 0")
        .withColumn("place", F.rank().over(by_value))
        .filter(F.col("place") <= top)
        .drop("place")
    )
    # Only what may be returned gets its text; ties at the last place are settled by it.
    named = first.join(texts, "digest").select(
        "lang", "source", F.when(F.col("split") == "", F.col("low")).otherwise(F.col("split")).alias("item"), "value"
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return (
        named.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    )
