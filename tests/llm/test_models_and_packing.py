"""Classifiers on held-out rows, packing as an exact round trip, and the pipeline stage by stage."""

from __future__ import annotations

import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from adlens.llm import packing, quality, queries, simhash, toxicity
from adlens.llm.sampling import labelled_sample

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(str(i).encode())


def read(sql):
    return duckdb.connect().execute(sql).fetchall()


@pytest.mark.parametrize("seed", range(4))
def test_pack_lengths_hold_each_token_once(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 63, 64, 100, 128, 500, 1000, 129 * 3]) for _ in range(rng.randint(0, 300))]
    pieces = packing.pack_lengths(lengths, 128)
    seen = [np.zeros(n, int) for n in lengths]
    sequences: dict = {}
    for d, s, n, q, o in pieces:
        assert n > 0
        seen[d][s : s + n] += 1
        sequences.setdefault(q, []).append((o, n))
    assert all((x == 1).all() for x in seen)
    for parts in sequences.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == 128 or at & (at - 1) == 0  # nothing is padded
    assert sum(lengths) <= 128 * len(sequences)


def test_first_fit_decreasing_matches_a_plain_loop():
    rng = random.Random(4)
    sizes = np.array([rng.randint(1, 100) for _ in range(400)])
    got, room, expected = packing.first_fit_decreasing(sizes, 100), [], np.zeros(400, int)
    for k in np.argsort(-sizes, kind="stable"):
        b = next((b for b, r in enumerate(room) if r >= sizes[k]), len(room))
        if b == len(room):
            room.append(100)
        room[b] -= sizes[k]
        expected[k] = b
    assert (got == expected).all()


def test_packing_round_trip(spark):
    rows = read(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'")
    odd = ["", None, "  A b c\x0bd\re ", "don't <|endoftext|>'s ÀÉ́ 1234 ---", "x" * 9000, "İΣ ς", "a\n\n\nb", "».. «a» e\u0301, \u0301. ÉTÉ!? x=\u0338 2,5 a.b. 日本, word.\u00a0b ı İx, it's, dogs'. ,a"]
    rows += [(10_000 + k, t) for k, t in enumerate(odd)] + [(10_000, "")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, length int, pack int")
    got = packing.pack(docs, queries.tokenizer_path(), group_bytes=150_000, with_ids=True).collect()
    whole = Tokenizer.from_file(queries.tokenizer_path())
    expected = sorted((i, whole.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows)
    parts: dict = {}
    for r in got:
        ids = np.array(r.ids, "<u4")
        assert (len(ids), zlib.crc32(ids.tobytes())) == (r.length, r.ids_crc32)
        parts.setdefault(r.doc_id, []).append((r.start, list(r.ids), r.doc_tokens))
    assert sorted({i for i, _ in expected}) == sorted(parts)
    for i, ids in expected:
        if i == 10_000:
            assert [p[1] for p in parts[i]] == [[2], [2]]
            continue
        assert sum((p[1] for p in sorted(parts[i])), []) == ids
        assert {p[2] for p in parts[i]} == {len(ids)}
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at == 4096 or at & (at - 1) == 0
    assert packing.pack(docs.limit(0), queries.tokenizer_path()).count() == 0


def test_marks_behind_letters_that_end_in_a_combining_mark(spark):
    texts = ["İ. x", "a İ!", "\u0958, y", "\ufb1d-", "«İ»."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = Tokenizer.from_file(queries.tokenizer_path())
    parts: dict = {}
    for r in packing.pack(docs, queries.tokenizer_path(), with_ids=True).collect():
        parts.setdefault(r.doc_id, []).append((r.start, list(r.ids)))
    assert sorted(parts) == list(range(len(texts)))
    for i, text in enumerate(texts):
        assert sum((ids for _, ids in sorted(parts[i])), []) == whole.encode(text, add_special_tokens=False).ids + [2]


def _counting_encoder(monkeypatch):
    encoder, learned = packing.WordEncoder(queries.tokenizer_path()), []
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda units: learned.extend(units) or learn(units))
    return encoder, learned


def test_words_are_encoded_once(monkeypatch):
    """A worker keeps half a million words, each apart from the marks behind it."""
    encoder, learned = _counting_encoder(monkeypatch)
    letters = np.frombuffer(b"etaoinshrdlucmfw", np.uint8)
    numbers = np.arange(500_000)
    words = letters[(numbers[:, None] >> np.arange(0, 20, 4)) & 15].tobytes().decode()
    words = [words[k : k + 5] for k in range(0, len(words), 5)]
    for mark in ("", "!", ".,"):
        for k in range(0, len(words), 100_000):
            encoder.encode(pa.array([f"{mark} ".join(words[k : k + 100_000]) + mark], pa.large_string()), 2)
        assert len(learned) == len(set(learned))
    assert set(learned) - {b""} == {w.encode() for w in words} | {b"!", b".,"}


def test_forgotten_words_are_learned_again(monkeypatch):
    encoder, learned = _counting_encoder(monkeypatch)
    monkeypatch.setattr(packing, "KNOWN_BYTES", 2000)
    texts = [" ".join(f"word{k}x{j}, Zug" for j in range(40)) for k in range(5)]
    for _ in range(2):
        for text in texts:
            ids, bounds = encoder.encode(pa.array([text, "", " ", text], pa.large_string()), 2)
            expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2]
            assert ids.tolist() == expected + [2, 2] + expected
            assert bounds.tolist() == [0, len(expected), len(expected) + 1, len(expected) + 2, 2 * len(expected) + 2]
    assert len(learned) > len(set(learned))


def test_texts_without_words():
    encoder = packing.WordEncoder(queries.tokenizer_path())
    for texts, bounds in ((["", ""], [0, 1, 2]), ([" \n", "\x0b"], [0, 1, 2]), ([], [0])):
        got = encoder.encode(pa.array(texts, pa.large_string()), 2)
        assert (got[0].tolist(), got[1].tolist()) == ([2] * len(texts), bounds)


def auc(score, label):
    ranks = np.argsort(np.argsort(score)) + 1
    ones = label == 1
    return (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


@pytest.mark.parametrize("name, column, parts, part, least", [("op4_toxicity", "toxic", 3, 1, 0.9), ("op8_quality", "quality", 5, 0, 0.97)])
def test_held_out_accuracy(spark, name, column, parts, part, least):
    rows = queries.QUERIES[name](spark, "/root/testdata/sf0.1").collect()
    label = dict(read(f"SELECT doc_id, {column} FROM '/root/testdata/sf0.1/labels.parquet'"))
    cut = queries.TOXIC_LEAST if column == "toxic" else queries.QUALITY_LEAST
    for r in rows:
        assert r.held_out == (crc(r.doc_id) % parts == part)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= cut)
    out = [r for r in rows if r.held_out and r.doc_id in label]
    score, truth = np.array([r.score for r in out]), np.array([label[r.doc_id] for r in out])
    assert auc(score, truth) > least


def test_labels_and_texts_of_all_kinds(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "x " * 200_000, "c"), (None, "y", "d")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, None, None), (3, 1, 1)], none.schema)
    for labels, value in ((none, 0.5), (one, 1.0)):
        q = quality.score_quality(docs, quality.fit_quality(docs, labels, F.lit(True)))
        t = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels, F.lit(True)))
        for rows in (q.collect(), t.collect()):
            assert [round(r.score, 3) for r in rows] == [value] * 4
            assert [r["_row"]["score"] for r in rows] == list("abcd")


def test_sample_is_bounded_and_leaves_held_out_rows(spark):
    labels = spark.range(6000).selectExpr("id AS doc_id", "CAST(id % 10 = 0 AS INT) AS toxic")
    got = labelled_sample(labels, "doc_id", "toxic", F.col("doc_id") % 3 != 1, 300).collect()
    ones = [r for r in got if r.label]
    assert 200 < len(ones) <= 400 and 200 < len(got) - len(ones) < 400
    assert all(r["_id"] % 3 != 1 for r in got)
    assert sum(r.weight for r in ones) == pytest.approx(400, rel=0.2)


def test_misspellings_share_ngrams():
    rng = random.Random(9)
    clean = [" ".join(rng.choice("alpha beta gamma delta omega sigma".split()) for _ in range(30)) for _ in range(300)]
    bad = [c + " horrible " + c for c in clean[:150]]
    bags = [toxicity.bag(t) for t in clean + bad]
    label = np.array([0.0] * len(clean) + [1.0] * len(bad))
    model = toxicity.fit_softmax(bags, label, np.ones(len(label)))
    ugly, fine = model.score(["alpha beta horribles gamma", "alpha beta gamma"])
    assert ugly > 0.7 > fine
    whole = model.score(["alpha horrible", "", "beta " * 300_000 + "horrible", "gamma"])
    assert [round(float(x), 9) for x in whole] == [round(float(model.score([t])[0]), 9) for t in ["alpha horrible", "", "beta " * 300_000 + "horrible", "gamma"]]


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit_trees(x[:3000], y[:3000], np.ones(3000))
    assert ((model.score(x[3000:]) > 0.5) == (y[3000:] == 1)).mean() > 0.97


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage against plain Python on the rows that the stage before has kept."""
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    now = {r.doc_id: r for r in docs.collect()}
    score = {r.doc_id: r.score for r in queries.op8_quality(spark, MORE).collect()}
    kept = {i: r for i, r in now.items() if score[i] >= queries.QUALITY_LEAST}
    steps = [kept]
    last = {}
    for i in sorted(kept):
        last[kept[i].text or ""] = i
    kept = {i: kept[i] for i in last.values()}
    steps.append(kept)
    prints = {i: simhash.fingerprint(r.text) for i, r in kept.items()}
    ids, root = sorted(kept), {i: i for i in kept}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    kept = {i: r for i, r in kept.items() if find(i) == i}
    steps.append(kept)
    sql = queries.OP5_SQL.replace("FROM documents", f"FROM '{MORE}/documents.parquet'")
    sql = sql.replace("FROM benchmark", f"FROM '{MORE}/benchmark.parquet'")
    hit = dict(read(f"SELECT doc_id, contaminated FROM ({sql})"))
    steps.append({i: r for i, r in kept.items() if not hit[i]})
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:4], steps, strict=True):
        out = str(tmp_path / name)
        got = stage(spark, docs, MORE)
        assert got.dtypes == docs.dtypes
        got.write.parquet(out)
        docs = spark.read.parquet(out)
        assert {r.doc_id: r for r in docs.collect()} == expected
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, MORE).collect()
    assert {r.doc_id for r in pieces} == set(steps[-1])
    assert len(steps[-1]) < len(steps[0]) < len(now)
