"""Ranked search against plain Python over all items and documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from areascore.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n = [sum(c.values()) for _, c in counts]
    N, L = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in counts for t in c)
    w = {t: math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) for t in df}
    out = []
    for item, text in items:
        found = []
        q = Counter(terms(text))
        for (i, c), size in zip(counts, n):
            m = 75 + 25 * size * N // max(L, 1)
            s = sum(k * w[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, k in q.items() if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "é", "A", "a", "Straße", "日本", "x1y2"]
    sep = [" ", "-", "_", "\n", "\x7f", "[", ", "]

    def text(n):
        return "".join(rng.choice(vocabulary[: rng.choice([5, 67])]) + rng.choice(sep) for _ in range(n))

    docs = [(rng.randrange(10**6) - 500, text(rng.choice([0, 1, 8, 40]))) for _ in range(300)]
    docs += [(2000 + i, "w1 w2 w3 tie") for i in range(60)] + [(None, "w1 w2 w3 tie")] * 3 + [(7, "w1 w2 w3 tie")] * 2
    docs += [(8, None), (9, ""), (10, "w9 " * 20_000), (2**62, "tie tie")]
    items = [(i, text(rng.choice([0, 1, 5, 60]))) for i in range(30)] + [(99, "tie"), (99, "tie"), (None, "w1 tie w9"), (100, None), (101, "nowhere"), (-1, "w3 " * 500)]
    return docs, items


@pytest.fixture(scope="module")
def tables(spark):
    docs, items = case(1)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("n")).withColumn("score", F.lit(0)).repartition(5)
    return docs, items, frame, spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1))


def test_equals_brute_force(tables):
    docs, items, d, i = tables
    assert sorted(map(tuple, search.search(d, i).collect()), key=repr) == brute(docs, items)


def test_small_tiles_and_blocks_give_the_same(tables, monkeypatch):
    docs, items, d, i = tables
    for name, value in (("ITEMS", 3), ("DOCS", 7), ("WORDS", 2)):
        monkeypatch.setattr(search, name, value)
    got = search.search(d, i, top=4, item_bytes=300)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, 4)


def test_empty_tables(spark, tables):
    docs, items, d, i = tables
    assert search.search(d.limit(0), i).count() == 0 and search.search(d, i.limit(0)).count() == 0
    assert search.search(d.filter("text is null"), i).count() == 0


def test_heavy_items_are_split_so_that_sums_stay_exact():
    rng = np.random.default_rng(1)
    weights = rng.integers(1, 30_000, 50)
    items = [Counter({int(t): int(q) for t, q in zip(rng.permutation(50)[:20], rng.integers(1, 2000, 20))}) for _ in range(9)]
    exact = 40_000 * search.IMPACT
    tile = search.ItemTile(items, weights, exact)
    assert len(tile.parts) > 20 and all(m.sum(axis=1).max() * search.IMPACT <= exact for _, m in tile.parts)
    words, docs = np.arange(50, dtype=np.int32).repeat(2), np.tile([0, 1], 50)
    impacts = rng.integers(1, search.IMPACT, 100).astype(float)
    got = tile.scores(np.full(50, -1, np.int32), words, docs, impacts, 2)
    want = [[sum(q * int(weights[t]) * int(impacts[2 * t + d]) for t, q in c.items()) for d in (0, 1)] for c in items]
    assert got.tolist() == want


def test_best_keeps_ties_by_key():
    best = search.Best(1, 3)
    best.add(0, np.array([[5, 9, 9, 9, 5]]), np.array([1, 8, 7, 6, 0]), np.array([False, False, False, True, False]))
    best.prune()
    best.add(0, np.array([[9, 9, 3]]), np.array([2, 9, 1]), np.array([False] * 3))
    best.prune()
    assert best.doc.tolist() == [2, 7, 8] and not best.null.any()
