"""URL filter, HTML extraction, WARC archives and licence scan on small tables."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random

import pytest

from adlens.llm import html_extract, license_scan, url_filter, warc

RULES = url_filter.rules_of("allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/")
PAGE_SCHEMA = "page_id long, url string, html string, id string, text string"


# -- URL filter


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host = rest[: min(ends)] if ends else rest
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.text)) if fits else None


def test_rules_and_model_agree_with_plain_python(spark):
    rng = random.Random(3)
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1?x#y", "http://xorg/", "http://org", "http://x.com#/de/"]
    urls += ["http://ü.example.org/ñ?://", "http://a.net/" + "x" * 5000, "http://a.org/en/://b"]
    for _ in range(800):
        host = rng.choice(["www.", "m.", ""]) + rng.choice(["win", "read", "casino"]) + ".example." + rng.choice(["org", "com", "net"])
        urls.append(f"http://{host}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randrange(300)}")
    rows = [(i, u, None, "x", None) for i, u in enumerate(urls)] + [(5, urls[5], None, None, None)]
    got = url_filter.judge(spark.createDataFrame(rows, PAGE_SCHEMA), RULES).collect()
    assert sorted(r["id"] for r in got) == sorted(r[0] for r in rows)
    for r in got:
        host, path, rule = plain_rule(urls[r["id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.text if rule else None)
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")
        assert (r["score"] is None) == (rule is not None)
    assert len({r["verdict"] for r in got if r["rule"] is None and "/es/" in r["path"]}) >= 1


def test_language_models_tell_words_of_blocked_urls(spark):
    rng = random.Random(4)
    rules = url_filter.rules_of("allow good.com/, block bad.com/")
    rows = []
    for i in range(1500):
        site, words = rng.choice([("good.com", ["recipes", "garden", "letters"]), ("bad.com", ["casino", "jackpot", "poker"])])
        rows.append((i, f"http://{site}/{rng.choice(words)}/{rng.randrange(90)}", None, None, None))
    rows += [(9001, "http://new.net/casino/7", None, None, None), (9002, "http://new.net/garden/7", None, None, None)]
    got = {r["id"]: r for r in url_filter.judge(spark.createDataFrame(rows, PAGE_SCHEMA), rules).filter("id > 9000").collect()}
    assert (got[9001]["verdict"], got[9002]["verdict"]) == ("block", "allow")
    empty = url_filter.judge(spark.createDataFrame([], PAGE_SCHEMA), rules)
    assert empty.collect() == []


# -- HTML extraction

CHROME = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><a href=/>Home</a></header><nav><ul><li>A<li>B</ul></nav><div class="cookie-notice">We use cookies on this page, accept.</div>
<article><h1>Head &amp; line</h1><p>First   text<br>with &copy; <b>bold</b> <a href="x>y">link</a><p>Second, short.
<script>var t = "</p><p>no</p>";</script><!-- <p>no</p> --><ul><li>item one</li><li>item two</li></ul>
<div class="ad">Buy now</div><form>Name <input name=q></form><p>Last one &lt;here&gt;</p></article>
<aside>Side text</aside><section id="comments"><article>Great post, thanks a lot for it</article></section><footer>&copy; x</footer></body></html>"""


def test_article_blocks_are_kept_and_the_rest_is_not(spark):
    long = "<article>" + "<p>word and word</p>" * 3000 + "</article>"
    cases = {
        CHROME: "Head & line\nFirst text with © bold link\nSecond, short.\nitem one\nitem two\nLast one <here>",
        None: "", "": "", " \n ": "", "<<<>>": "", "<nav>Only <b>menu": "", "<article>cut off <a hre": "cut off",
        "<article>x &am": "x &am", "<article><p>a < b": "a < b", long: "\n".join(["word and word"] * 3000),
        "<script>never closed <p>text": "", "<article><nav>m</nav>text</article>tail": "text",
    }
    rows = [(i if i else None, None, p, "x", "y") for i, p in enumerate(cases)]
    got = html_extract.extract(spark.createDataFrame(rows, PAGE_SCHEMA)).collect()
    found = {r["id"]: r["text"] for r in got}
    assert found == {i if i else None: t for i, t in enumerate(cases.values())}
    assert html_extract.extract(spark.createDataFrame([], PAGE_SCHEMA)).collect() == []


def test_minimum_cut_is_the_cheapest_labelling():
    rng = random.Random(1)
    for _ in range(150):
        n = rng.randrange(1, 9)
        scores = [rng.randrange(-8, 9) / 2 for _ in range(n)]
        edges = [(a, b, rng.randrange(0, 7) / 2) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(keep, scores=scores, edges=edges):
            own = sum(max(s, 0) if not k else max(-s, 0) for s, k in zip(scores, keep, strict=True))
            return own + sum(w for a, b, w in edges if keep[a] != keep[b])

        best = min(cost(k) for k in itertools.product([False, True], repeat=n))
        assert cost(html_extract.source_side(scores, edges)) == pytest.approx(best)


def test_smoothing_keeps_a_short_block_among_long_ones():
    text = "A sentence that is long enough to be taken for content by its length alone, as most paragraphs are. "
    page = f"<div><p>{text * 2}</p><p>Short one, but in between them all, so it stays here.</p><p>{text * 2}</p></div><div><ul><li><a href=a>x</a></ul></div>"
    assert "Short one" in html_extract.main_text(page)[0]
    assert "x" not in html_extract.main_text(page)[0].split("\n")


# -- WARC


def test_archives_give_back_every_payload(spark):
    mark = "\r\n\r\nWARC/1.0\r\n"
    bodies = [None, "", "same", "same", "same", "é\r\n", mark, f"a{mark}b{mark}c{mark}", "x\r\n\r\nWARC/1.0", "\r\n\r\n", "\n\n", "x" * 50_000]
    bodies += [mark[:-1], mark[2:], mark + mark, "\r\n\r\n\r\nWARC/1.0\r\nñ", "\x00", "\r\n\r\nWA\r\n\r\nWA"]
    rows = [(100 - i, f"http://b.example/{i}?q\nz", b, "x", "y") for i, b in enumerate(bodies)]
    rows += [(None, None, "same", None, None), (7, "http://a.example/", "twice", None, None), (7, "http://a.example/", "twice", None, None)]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA)
    got = warc.read_archives(spark, warc.write_archives(pages)).collect()
    assert len(got) == len(rows)
    firsts = {}
    for number, _, body, *_ in rows:
        if number is not None:
            firsts[body or ""] = min(firsts.get(body or "", number), number)
    wanted, seen = [], []
    for number, _, body, *_ in rows:
        raw = (body or "").encode()
        first = firsts[body or ""]
        response = number == first
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        wanted.append((number or -1, digest, len(raw), "response" if response else "revisit", None if response else first, raw if response else None))
    for r in got:
        seen.append((r["id"] or -1, r["digest"], r["bytes"], r["record_type"], r["refers_to"], bytes(r["payload"]) if r["payload"] is not None else None))
    assert sorted(map(repr, seen)) == sorted(map(repr, wanted))
    plain = warc.read_archives(spark, warc.write_archives(pages, least_bytes=5)).filter("bytes < 5").collect()
    assert plain and {r["record_type"] for r in plain} == {"response"}


def test_false_positives_of_the_bitmap_keep_their_payload(spark, monkeypatch):
    monkeypatch.setattr("adlens.llm.bitmap.BITS", 64)
    rows = [(i, "http://e.com/a", f"page {i % 40 if i < 60 else i}") for i in range(120)]
    records = warc.read_archives(spark, warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    payload = {i: html for i, _, html in rows}
    assert len(records) == len(rows)
    for r in records:
        if 40 <= r["id"] < 60:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", r["id"] - 40, None)
        else:
            assert (r["record_type"], bytes(r["payload"]).decode()) == ("response", payload[r["id"]])


def test_index_is_in_global_order(spark):
    rng = random.Random(2)
    rows = [(i, f"http://{rng.choice(['www.', ''])}{rng.choice('ab')}.example.org/{rng.randrange(4)}", str(i % 50), None, None) for i in range(400)]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA).repartition(5)
    index = warc.capture_index(warc.read_archives(spark, warc.write_archives(pages)), range_rows=60).collect()
    placed = sorted(index, key=lambda r: (r["range_no"], r["position"]))
    assert [(r["url_key"], r["id"]) for r in placed] == sorted((r["url_key"], r["id"]) for r in index)
    assert len({r["range_no"] for r in index}) > 2 and sorted(r["id"] for r in index) == list(range(400))
    assert {r["url_key"] for r in index} >= {"org,example,a)/0", "org,example,b)/3"}
    none = spark.createDataFrame([], PAGE_SCHEMA)
    assert warc.capture_index(warc.read_archives(spark, warc.write_archives(none))).collect() == []


def test_loser_tree_merges_like_sorted():
    rng = random.Random(5)
    for k in range(0, 9):
        runs = [sorted(rng.randrange(30) for _ in range(rng.randrange(12))) for _ in range(k)]
        assert list(warc.merge_runs(runs)) == sorted(itertools.chain(*runs))


# -- licence scan


def plain_scan(text):
    passages = (text or "").split("\n") + [p for p in (text or "").split("\n\n") if "\n" in p]
    found = []
    for passage in passages:
        own = set(license_scan.bigrams_of(passage))
        for name, template in license_scan.TEMPLATES:
            other = set(license_scan.bigrams_of(template))
            dice = 2 * len(own & other) / (len(own) + len(other)) if own else 0.0
            if dice >= license_scan.LEAST_DICE - 1e-9:
                found.append((-round(dice, 9), name))
    return sorted(found)


def test_scan_agrees_with_every_template_compared(spark):
    rng = random.Random(6)
    texts = [None, "", "one", "licensed under the", "words " * 20_000]
    for _, template in license_scan.TEMPLATES:
        words = template.split()
        texts += [template, template.upper(), "Intro text.\n" + template + "\nmore", "\n".join([" ".join(words[: len(words) // 2]), " ".join(words[len(words) // 2 :])])]
        for changes in (1, 2, 4):
            own = list(words)
            for _ in range(changes):
                own[rng.randrange(len(own))] = "other"
            texts.append(" ".join(own))
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(0, None, "y", 2)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, id string, matches int")).collect()
    assert len(got) == len(rows)
    for r in got:
        wanted = plain_scan(texts[r["id"]])
        assert sorted((-round(m["dice"], 9), m["license"]) for m in r["matches"]) == wanted
        assert r["best_license"] == (wanted[0][1] if wanted else None)
        assert r["licenses"] == sorted({n for _, n in wanted})
