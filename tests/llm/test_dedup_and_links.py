"""Exact dedup, SimHash, decontamination and components against brute force on small tables."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from adlens.llm import decontaminate, exact_dedup, simhash
from adlens.llm.components import components

SCHEMA = "doc_id long, text string, _id long, kept string, group_size int"


def table(spark, rows):
    """Rows (id, text) with extra columns whose names clash with those the operators use."""
    return spark.createDataFrame([(i, t, 7, "x", 1) for i, t in rows], SCHEMA)


def union_find(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


ROWS = [
    (1, "a b c"), (2, "a b c"), (9, "a b c"), (3, ""), (4, None), (5, "x" * 200_000), (6, "x" * 200_000),
    (7, "x" * 199_999 + "y"), (8, "A b c"), (None, "a b c"), (None, "alone"), (11, "alone too"), (2, "a b c"),
]


def test_exact_groups(spark):
    got = exact_dedup.exact_groups(table(spark, ROWS), digest_all=True).collect()
    assert len(got) == len(ROWS)
    groups: dict = {}
    for i, t in ROWS:
        groups.setdefault(t or "", []).append(i)
    for r in got:
        members = groups[r["_row"]["text"] or ""]
        keep = max((m for m in members if m is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(members), r["_id"] == keep)
    assert len({r.text_sha256 for r in got}) == len(groups)


def test_keep_one_keeps_columns_and_one_row(spark):
    docs = table(spark, [*ROWS, (9, "a b c")])
    got = exact_dedup.keep_one(docs)
    assert got.dtypes == docs.dtypes
    texts = [r.text or "" for r in got.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in ROWS})


def test_pruned_rows_are_not_hashed(spark):
    got = exact_dedup.exact_groups(table(spark, [(1, "same start a"), (2, "same start bb"), (3, "other")]))
    assert {r.text_sha256 for r in got.collect()} == {None}


def test_empty_tables(spark):
    docs = table(spark, [])
    assert exact_dedup.exact_groups(docs).count() == 0
    assert exact_dedup.keep_one(docs).count() == 0
    assert simhash.near_duplicates(docs).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, items).count() == 0
    some = decontaminate.contamination(table(spark, [(1, "a b")]), items).collect()
    assert [(r.n_words, r.n_hit, r["items"]) for r in some] == [(2, 0, [])]


def plain_fingerprint(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aBcÄß \t\n\x0b\x1c x1", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_hashes_like_spark(spark):
    text = "One two Three"
    row = spark.sql("SELECT xxhash64('one two three') AS h").first()
    assert np.uint64(simhash.fingerprint(text)).view(np.int64) == row.h
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_masks_cover_the_radius():
    masks, rng = simhash.covering_masks(3), random.Random(3)
    for _ in range(3000):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
        assert any(not flips & m for m in masks)


def near_prints(seed, centres=6, members=40):
    rng = random.Random(seed)
    out = {0}
    for _ in range(centres):
        base = rng.getrandbits(64)
        for _ in range(members):
            out.add(base)
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
    return sorted(out)


def test_links_have_the_components_of_all_pairs(spark):
    prints = near_prints(5)
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    pairs = [(a, b) for a, x in zip(signed, prints, strict=True) for b, y in zip(signed, prints, strict=True) if a < b and (x ^ y).bit_count() <= 3]
    expected = union_find(signed, pairs)
    assert 7 < len(set(expected.values())) < len(signed)
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    for bucket_rows in (20_000, 2):  # the second sends all buckets of three or more the other exact way
        links = simhash.close_links(df, 3, bucket_rows)
        roots = {r.a: r.root for r in components(links).collect()}
        assert {s: roots.get(s, s) for s in signed} == expected


def test_near_duplicates(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(500)]
    base = " ".join(rng.choice(words) for _ in range(4000))
    rows = [(k + 10, " ".join([*base.split()[: 3999 - k], "changed"])) for k in range(6)]
    rows += [(3, base), (2, base), (None, base), (40, " ".join(rng.choice(words) for _ in range(900))), (50, ""), (51, None), (3, base)]
    got = simhash.near_duplicates(table(spark, rows)).collect()
    assert len(got) == len(rows)
    prints = {t: plain_fingerprint(t) for _, t in rows}
    for r in got:
        assert r.fp & (1 << 64) - 1 in prints.values()
    nodes = sorted(set(prints.values()))
    roots = union_find(nodes, [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 3])
    least: dict = {}
    for i, t in rows:
        if i is not None:
            least[roots[prints[t]]] = min(i, least.get(roots[prints[t]], i))
    for r in got:
        assert r.component_id == least[roots[r.fp & (1 << 64) - 1]]


def plain_contamination(docs, items, window):
    out = []
    for i, text in docs:
        words, hit, found = decontaminate.words_of(text), set(), set()
        for j, item in items:
            own = decontaminate.words_of(item)
            n = min(window, len(own))
            for p in range(len(own) - n + 1 if own else 0):
                for q in range(len(words) - n + 1):
                    if words[q : q + n] == own[p : p + n]:
                        hit.update(range(q, q + n))
                        found.add(j)
        out.append((i, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


def test_contamination_in_one_block_and_in_many(spark):
    rng = random.Random(2)
    words = ["Aa", "bé", "c1", "the", "the,", "Z-z"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, text(n)) for k, n in enumerate([1, 3, 4, 5, 8, 10, 12, 30, 0])] + [(9, None), (10, "c1 c1 c1 c1"), (10, "c1 c1 c1 c1")]
    docs = [(k, text(rng.randint(0, 200))) for k in range(25)] + [(30, None), (31, items[7][1] + " " + items[7][1]), (31, items[7][1])]
    docs += [(33, "the the"), (33, "the the")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    for block in (1_000_000, 20):
        got = decontaminate.contamination(table(spark, docs), frame, window=6, block_windows=block).collect()
        assert sorted(((r.id, r.n_words, r.n_hit, sorted(r["items"])) for r in got), key=str) == plain_contamination(docs, items, 6)


def test_rarest_shingle_is_looked_up():
    import pandas as pd

    index = decontaminate.build_index(pd.DataFrame({"item_id": [1], "text": ["a a a a a a a b a a a a"]}))
    group = index.groups[0]
    keys = np.unique(group.shingles())
    counts = np.where(np.isin(keys, group.shingles()[0][:1]), 1000, 1)
    group.pick(keys, counts)
    assert (group.offset > 0).any()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1400)] + [(5, 5)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.a: r.root for r in got} == {**{k: 0 for k in range(1, 301)}, **{k: 1000 for k in range(1001, 1400)}}
