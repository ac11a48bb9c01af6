"""The character models and the limit of the URL filter against plain Python."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from adlens.llm import url_filter
from adlens.llm.url_filter import END, LEAST_COUNT, ORDER, START, SYMBOLS


def positions(text):
    padded = START * ORDER + text + END
    return [(padded[i : i + ORDER], padded[i + ORDER]) for i in range(len(text) + 1)]


def plain_model(rows):
    counts = defaultdict(lambda: (Counter(), Counter()))
    for text, a, r in rows:
        for before, symbol in positions(text):
            for k in range(ORDER + 1):
                own = counts[before[ORDER - k :]]
                own[0][symbol] += a
                own[1][symbol] += r
    kept = {c: own for c, own in counts.items() if c == "" or sum(own[0].values()) + sum(own[1].values()) >= LEAST_COUNT}

    def share(which, context, symbol):
        shorter = share(which, context[1:], symbol) if context else 1 / len(SYMBOLS)
        own = kept[context][which]
        kinds = max(sum(n > 0 for n in own.values()), 1)
        return (own[symbol] + kinds * shorter) / (sum(own.values()) + kinds)

    def score(text):
        total = 0.0
        for before, symbol in positions(text):
            context = next(before[k:] for k in range(ORDER + 1) if before[k:] in kept)
            total += math.log(share(0, context, symbol) / share(1, context, symbol))
        return total / (len(text) + 1)

    return score, kept


@pytest.mark.parametrize("few_grams", [0, 10**6])
def test_scores_equal_a_plain_model(spark, few_grams):
    rng = random.Random(3)
    words = ["casino", "poker", "garden", "letters", "a", "\x01x", "~"]
    rows = [(f"http://h{rng.randrange(9)}.org/{rng.choice(words)}/{rng.randrange(40)}", rng.randrange(4), rng.randrange(3)) for _ in range(400)]
    rows = [(t, a, r) for t, (a, r) in {t: (a, r) for t, a, r in rows}.items()]
    score, kept = plain_model(rows)
    train = spark.createDataFrame(rows, "text string, accepted long, rejected long")
    model = url_filter.fit_ratio(train)
    assert {r["context"] for r in model.select("context").collect()} == set(kept)
    asked = [t for t, _, _ in rows[:50]] + ["", "zzz", "http://new.net/casino/7", "http://new.net/casino/7"]
    got = url_filter.score_ratio(spark.createDataFrame([(t,) for t in asked], "text string"), model, few_grams).collect()
    assert len(got) == len(set(asked))
    for r in got:
        assert r["score"] == pytest.approx(score(r["text"]), abs=1e-9)


def test_limit_separates_best(spark):
    rng = random.Random(5)
    rows = [(str(i), round(rng.gauss(0.5 if i % 2 else -0.5, 0.6), 2), i % 2, 1 - i % 2) for i in range(200)]
    limit = url_filter.calibrated_limit(spark.createDataFrame(rows, "text string, score double, accepted long, rejected long"))

    def right(at):
        return sum(a for _, s, a, _ in rows if s >= at) / 100 + sum(r for _, s, _, r in rows if s < at) / 100

    assert right(limit) == pytest.approx(max(right(s) for _, s, _, _ in rows))


def test_every_frequent_context_is_kept(spark):
    """Far more contexts than any cap would leave."""
    rows = [(f"{i:05d}", 30, 1) for i in range(0, 100_000, 4)]
    model = url_filter.fit_ratio(spark.createDataFrame(rows, "text string, accepted long, rejected long"))
    assert model.filter("length(context) = 4").count() > 10_000
