"""Recall of near-duplicate vectors by cosine, on pairs planted among the given vectors."""

import numpy as np
import pytest

from areascore.llm import embeddings


@pytest.mark.parametrize("pivots", [None, 1000])
@pytest.mark.parametrize("cosine", [0.9801, 0.985, 0.99, 0.995])
def test_distinct_pairs_are_found_at_every_cosine(spark, cosine, pivots):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    rng, rows = np.random.default_rng(6), []
    for i, r in enumerate(given):
        v = np.array(r["embedding"], float)
        v /= np.sqrt(v @ v)
        noise = rng.normal(size=len(v))
        noise -= noise @ v * v
        other = cosine * v + np.sqrt(1 - cosine**2) * noise / np.sqrt(noise @ noise)
        # a label of its own, so that a link is this pair's
        rows += [(2 * i, v.tolist(), str(i)), (2 * i + 1, other.tolist(), str(i))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    found = embeddings.near_duplicates(df, pivots=pivots).filter("n_links = 1 and vec_id % 2 = 1").count()
    print("recall", pivots, cosine, found / len(given))
    assert found >= 0.97 * len(given)


def test_points_grow_with_the_vectors_and_rare_lengths_have_some(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist(), "a") for i in range(9000)]
    rows += [(20_000 + 10 * k + c, (np.arange(1.0, k + 1) + (c * 1e-3)).tolist(), "b") for k in range(5, 40) for c in range(3)]
    df = spark.createDataFrame(rows, "node long, vector array<double>, label string").selectExpr("*", "node h1", "node h2")
    drawn = embeddings.draw_pivots(df)
    assert len(drawn[4]) == 9000 // 64 and len(drawn) == 16
    found = embeddings.near_duplicates(df.filter("label = 'b'"), "node", "vector").collect()
    assert len(found) == 105 and all(r["n_links"] == 2 for r in found)


def test_orders_count_shared_points_and_places():
    near = np.array([[3, 1, 2, 9], [3, 1, 2, 8], [9, 2, 1, 3], [7, 6, 5, 4], [1, 7, 2, 3]])
    good = embeddings.alike_orders(near, 1, 3, 100)
    assert good[0, 1] and good[0, 2] and not good[0, 3] and good[0, 4]
    assert not embeddings.alike_orders(near, 2, 3, 100)[0, 1]  # 1 comes first
    # places 0 1 2 3 against 3 2 1 0: 3 + 1 + 1 + 3
    assert not embeddings.alike_orders(near, 1, 3, 7)[0, 2] and embeddings.alike_orders(near, 1, 3, 8)[0, 2]
