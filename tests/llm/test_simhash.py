"""SimHash near-duplicates against plain Python over all pairs."""

import re

import pytest
import xxhash

from areascore.llm import simhash


def plain_fingerprint(text, shingle=3):
    text = "" if text is None else text
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(docs):
    """doc_id -> (fingerprint, component_id) by all pairs."""
    fps = {i: plain_fingerprint(t) for i, t in docs}
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (f"{fps[i]:016x}", find(i)) for i in ids}


def got(df):
    return {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("block", [3, 2000])
def test_equals_all_pairs_on_the_given_documents(spark, block):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    # near copies of a long document: a third of all rows in a few buckets
    words = max((t for _, t in rows), key=len).split()
    near = [(10_000 + i, " ".join(w if j != i * 3 else "x" for j, w in enumerate(words))) for i in range(100)]
    both = docs.union(spark.createDataFrame(near, "doc_id long, text string"))
    assert got(simhash.near_duplicates(both, block=block)) == plain(rows + near)


def test_masks_cover_every_three_bits():
    masks = simhash.covering_masks()
    assert len(masks) == 15
    for i in range(64):
        for j in range(i, 64):
            for k in range(j, 64):
                assert any(not (m >> i & 1 or m >> j & 1 or m >> k & 1) for m in masks)


def test_nulls_empty_ties_long_and_clashing_columns(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t", None), (4, "One", "c"), (5, "one", "d"), (None, "x y", "e"),
            (6, "w " * 50_000, "f"), (6, "w " * 50_000, "f"), (7, "Été été a b", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    found = simhash.near_duplicates(df).collect()
    assert len(found) == 9
    by = {r["doc_id"]: r for r in found}
    assert by[1]["fingerprint"] == "0" * 16 and [by[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 1]
    assert by[5]["component_id"] == 4 and by[None]["component_id"] is None
    assert by[7]["fingerprint"] == f"{plain_fingerprint(rows[-1][1]):016x}"
    kept = simhash.representatives(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "6", "7", "None"]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
