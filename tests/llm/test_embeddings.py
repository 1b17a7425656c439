"""Near-duplicate vectors against brute force."""

import math

import numpy as np
import pytest

from areascore.llm import embeddings


def plain(rows, least=0.98):
    """vec_id -> (n_links, component_id) over all pairs, in double precision."""
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    near = (x @ x.T >= least) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None])
    np.fill_diagonal(near, False)
    root = np.array(ids)
    while True:
        new = np.array([min([root[i], *root[near[i]]]) for i in range(len(ids))])
        if (new == root).all():
            return {i: (int(n), int(r)) for i, n, r in zip(ids, near.sum(axis=1), root)}
        root = new


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_and_precision_on_the_given_vectors(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    want = plain([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(df).collect()}
    assert set(found) == set(want)
    total = sum(n for n, _ in want.values())
    assert all(found[i]["n_links"] <= n for i, (n, _) in want.items())
    assert sum(r["n_links"] for r in found.values()) >= 0.95 * total
    same = sum(found[i]["component_id"] == c for i, (_, c) in want.items())
    assert same >= 0.97 * len(want)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


@pytest.mark.parametrize("block", [7, 1000])
def test_a_large_group_in_blocks_counts_each_link_once(spark, block):
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    rows = [(i, [float(v) for v in base + rng.normal(size=16) * 0.05], 1) for i in range(60)]
    rows += [(100 + i, [float(v) for v in base], 1) for i in range(40)]
    rows += [(200 + i, [float(v) for v in base], 2) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    # with as many pivots as a vector may share, no pair is lost
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(df, pivots=5, block=block).collect()}
    assert got == plain(rows)


def test_nulls_zero_vectors_repeats_and_clashing_columns(spark):
    nan, v = math.nan, [1.0, 2.0, 2.0]
    rows = [(1, v, 1, 0), (2, v, 1, 0), (2, v, 1, 0), (3, [2.0, 4.0, 4.0], 1, 0), (4, None, 1, 0), (5, [0.0, 0.0, 0.0], 1, 0),
            (6, [1.0, None, 2.0], 1, 0), (7, [nan, 1.0, 1.0], 1, 0), (8, [math.inf, 1.0, 1.0], 1, 0), (9, v, None, 0),
            (None, v, 1, 0), (10, v, 2, 0), (11, [], 1, 0), (12, [1.0, 2.0, 2.0, 0.0], 1, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links int")
    found = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(df).collect()), key=str)
    linked = [x for x in found if x[1]]
    assert linked == [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (3, 3, 1, False)]
    assert all(x[2] == x[0] and x[3] for x in found if not x[1]) and len(found) == 14
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
