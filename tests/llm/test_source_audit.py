"""Source audit against a plain loop, with digests that collide."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.llm import source_audit
from adlens.llm.source_audit import TermCounter, _share, audit, exact_share

SCHEMA = "doc_id long, text string, lang string, source string, term string, digest long, counts int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def table(spark, rows):
    return spark.createDataFrame([(i, t, l, s, "x", 1, 2) for i, (t, l, s) in enumerate(rows)], SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, least=30, top=50, unit=10**9, prior=5):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for t, l, s in rows:
        l, s = l or "", s or ""
        words = TERM.findall(lower(t or ""))
        groups[l].add(s)
        counts[l, s].update(words)
        docs[l].update(set(words))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + unit * (c[t] + prior) // (total + prior * v) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - whole[t]) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(ranked)}
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]


def texts(seed=5, n=400):
    rng = random.Random(seed)
    words = [w + e for w in ("Haus", "maison", "été", "ÄB", "ÀÉ", "x", "zoo", "日本", "a b") for e in ("", "s", "n", "q")]
    out = []
    for i in range(n):
        lang, source = rng.choice(["de", "fr", "", None]), rng.choice(["s1", "S1", "é", "", None, "s2"])
        if i % 3 == 0:
            source = "hot"
        weights = [1 + (hash_of(w, source) % 7) for w in words]
        out.append((rng.choice([" ", "-", "1", "\t"]).join(rng.choices(words, weights, k=rng.randint(0, 12))), lang, source))
    return out + [(None, "de", "quiet"), ("", "xx", "only"), ("alone", "yy", "a"), ("alone", "yy", "b"), ("a" * 200_000, "de", "hot")]


def hash_of(*parts):
    return sum(ord(c) * (i + 3) for p in parts for i, c in enumerate(p or ""))


@pytest.mark.parametrize("digest", [F.xxhash64, lambda c: F.pmod(F.xxhash64(c), F.lit(3)), lambda c: F.lit(7).cast("long")])
def test_results_do_not_depend_on_digests(spark, digest):
    rows = texts()
    want = plain(rows, least=12, top=6)
    got = rows_of(audit(table(spark, rows).repartition(5), least_docs=12, top=6, digest=digest))
    assert len(got) == len(set(got)) and set(got) == want


def test_blocks_and_tiles(spark):
    rows = texts(8)
    want = plain(rows, least=5)
    assert set(rows_of(audit(table(spark, rows), least_docs=5, least_block=4, most_block=6, tile_sources=2))) == want


def test_nothing_kept_and_empty_table(spark):
    rows = [("a b", "en", "x"), ("c", "en", "y"), (None, None, None)]
    got = rows_of(audit(table(spark, rows)))
    assert sorted(got) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert rows_of(audit(table(spark, []))) == []


def test_ties_rank_by_bytes(spark):
    rows = [("é z Z a", "en", "x")] * 3 + [("q", "en", "y")] * 3 + [("q", "en", "w")] * 3
    got = sorted(rows_of(audit(table(spark, rows), least_docs=3, top=2)))
    assert set(got) == plain(rows, least=3, top=2)
    assert [(r[3], r[5]) for r in got if r[1] == "x" and r[2] == "term"] == [("a", 2), ("z", 1)]
    assert [(r[3], r[5]) for r in got if r[1] == "x" and r[2] == "pair"] == [("w", 1), ("y", 2)]


def test_shares_are_exact_for_large_counts(spark):
    counts = [(0, 1, 1), (3, 7, 2), (10**12, 3 * 10**15, 10**6), (5, 10**15 + 7, 11), (999, 999, 1)]
    df = spark.createDataFrame(counts, "c long, n long, v long")
    got = [r[0] for r in df.select(exact_share(F.col("c"), F.col("n"), F.col("v"))).collect()]
    want = [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in counts]
    assert got == want
    c, n, v = (np.array(x, np.int64) for x in zip(*counts, strict=True))
    assert _share(c, n + 5 * v, 10**9, 5).tolist() == want


def test_counter_forgets_and_still_adds_up(monkeypatch):
    monkeypatch.setattr(source_audit, "BATCH_DOCS", 3)
    rows = [("b a a", "l", "s"), ("a", "l", "s"), ("", "l", "t"), ("é a", "l", "t"), ("b", "m", "s")]
    found, seen, groups = Counter(), Counter(), set()
    counter = TermCounter()
    for k, (t, l, s) in enumerate(rows):
        counter.add((l, s), t.encode())
        if k in (1, 4):
            for batch in counter.drain():
                for r in batch.to_pylist():
                    for c in r["counts"]:
                        groups.add((c["lang"], c["source"]))
                        if r["term"] is not None:
                            found[r["term"], c["lang"], c["source"]] += c["n"]
                            seen[r["term"], c["lang"], c["source"]] += c["docs"]
    assert groups == {("l", "s"), ("l", "t"), ("m", "s")}
    assert found == {("a", "l", "s"): 3, ("b", "l", "s"): 1, ("a", "l", "t"): 1, ("é", "l", "t"): 1, ("b", "m", "s"): 1}
    assert seen["a", "l", "s"] == 2
