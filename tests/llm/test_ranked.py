import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from fleetmart.llm import ranked

TERM = re.compile("[0-9a-z\x80-\U0010ffff]+")


def terms_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def by_hand(docs, items, k):
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, text in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms_of(text))
    rows = []
    for item, wanted in asked.items():
        scores = []
        for i, c in held:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in wanted if t in c)
            if score > 0 and i is not None:
                scores.append((-score, i))
        rows += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows)


def corpus(seed, number):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "漢字", "x9"]
    rows = [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(63)], k=rng.choice([0, 1, 3, 30, 300])))) for i in range(number)]
    rows += [(number + i, rows[3][1]) for i in range(40)] + [rows[5], rows[5]]  # ties, repeated rows
    return rows + [(None, "w1 w2 w3"), (9001, None), (9002, ""), (9003, "!? -"), (9004, "W1-w2_w3  ÉTÉ été"), (-4, "w1 " * 5000)]


ITEMS = [(1, "w1 w2 w2 W3"), (2, "w40 w50, W59"), (3, "Été 漢字 x9 w0"), (4, ""), (5, None), (6, "nowhere"), (7, "w1"), (7, "w30"),
         (8, " ".join(f"w{i}" for i in range(60))), (None, "w1"), (1, "w1 w2 w2 W3")]


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id long, text string, score string, rank int")


@pytest.mark.parametrize("k, block", [(10, 50_000), (1000, 50_000), (3, 20)])
def test_results_equal_brute_force(spark, docs_of, monkeypatch, k, block):
    monkeypatch.setattr(ranked, "BLOCK_TERMS", block)
    rows = corpus(k, 150)
    got = ranked.ranked_search(docs_of(rows), items_of(spark, ITEMS), k)
    assert sorted(map(tuple, got.collect())) == by_hand(rows, ITEMS, k)


@pytest.mark.parametrize("short, at_once, documents", [(1, 1, 64), (1, 300, 200), (5, 7, 1000), (1024, 512, 16_384)])
def test_intervals_find_the_best(monkeypatch, short, at_once, documents):
    """The search itself, with intervals split down to single postings and shards of few documents."""
    monkeypatch.setattr(ranked, "SHORT", short)
    monkeypatch.setattr(ranked, "AT_ONCE", at_once)
    rng = np.random.default_rng(short + at_once)
    known, number, k = 40, 700, 10
    held = rng.random((number, known)) < 1 / (1 + np.arange(known))
    impact = rng.integers(1, 6, (number, known)) * held  # many ties
    items = [np.sort(rng.choice(known, rng.integers(0, 12), replace=False)) for _ in range(25)]
    ids = rng.permutation(number) - 300
    best = [[] for _ in items]
    for a in range(0, number, documents):
        document, place = np.nonzero(held[a:a + documents])
        shard = ranked.Shard(known, ids[a:a + documents], document, place, impact[a:a + documents][document, place])
        shard.search(items, best, k)
    for wanted, found in zip(items, best):
        scores = impact[:, wanted].sum(axis=1)
        want = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if s > 0)[:k]
        assert sorted((-s, -i) for s, i in found) == want


def test_sparse_tables_answer_every_stretch():
    rng = np.random.default_rng(3)
    place = np.repeat(np.arange(3), [1, 50, 17])
    document = np.concatenate([[4], np.arange(50), np.arange(17) * 3])
    shard = ranked.Shard(3, np.arange(60), document, place, rng.integers(0, 9, 68))
    for first, last in ((0, 1), (1, 51), (51, 68)):
        for a in range(first, last):
            for b in range(a + 1, last + 1):
                top = int(shard.maxima(np.array([a]), np.array([b]))[0])
                assert a <= top < b and shard.impact[top] == shard.impact[a:b].max()


def test_empty_tables(spark, docs_of):
    some, none = docs_of([(1, "a b")]), docs_of([])
    assert ranked.ranked_search(none, items_of(spark, ITEMS)).count() == 0
    assert ranked.ranked_search(some, items_of(spark, [])).count() == 0
    assert ranked.ranked_search(none, items_of(spark, [])).count() == 0
    assert ranked.ranked_search(docs_of([(1, None), (2, "")]), items_of(spark, ITEMS)).count() == 0
