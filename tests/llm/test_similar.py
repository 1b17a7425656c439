"""The near-duplicate stage against brute force over five-word shingles."""

import random

import corpus_pipeline
from areascore.llm import simhash


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def planted(seed=1, each=60):
    """(length, similarity band, text, changed text) with similarities from 0.6 up."""
    rng, out = random.Random(seed), []
    for n in (60, 150, 400):
        for band in (0.6, 0.7, 0.8, 0.85, 0.9, 0.95):
            done = 0
            while done < each:
                words = [f"w{rng.randrange(5000)}" for _ in range(n)]
                other = list(words)
                for _ in range(rng.randrange(1, 2 + n // 30)):
                    other[rng.randrange(n)] = f"x{rng.randrange(5000)}"
                if rng.random() < 0.5:  # further words at the end move the similarity between the steps
                    other += [f"y{rng.randrange(5000)}" for _ in range(rng.randrange(n // 5))]
                a, b = " ".join(words), " ".join(other)
                if band <= jaccard(a, b) < band + (0.1 if band < 0.8 else 0.05):
                    out.append((n, band, a, b))
                    done += 1
    return out


def test_near_copies_are_found_by_similarity_and_length(spark):
    pairs = planted()
    rows = [(2 * i + k, p[2 + k]) for i, p in enumerate(pairs) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert all(2 * i in kept for i in range(len(pairs)))
    found = {}
    for i, (n, band, _, _) in enumerate(pairs):
        found.setdefault((n, band), []).append(2 * i + 1 not in kept)
    for (_, band), v in found.items():
        assert sum(v) == 0 if band < 0.8 else sum(v) >= 0.95 * len(v)


def test_the_sign_bit_is_one_of_the_differing_bits(spark):
    fps = [0b1011, 0b1011 - 2**63, 0b1010 - 2**63, 2**62 + 2**40 + 2**41 + 2**42 + 2**43]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()
    assert {x for r in links for x in (r["a"], r["b"])} == set(fps[:3])


def test_a_chain_copies_odd_rows_and_small_blocks(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows, chain = [], list(words)
    for i in range(40):  # each is near the one before, the last is far from the first
        rows.append((100 + i, " ".join(chain)))
        chain[i * 5 : i * 5 + 1] = [f"x{i}"]
    rows += [(500 + i, " ".join(words)) for i in range(30)]
    rows += [(1, None), (2, ""), (3, "One two"), (4, "one  TWO"), (5, "one three"), (None, " ".join(words)), (None, "a"), (7, "q r s t u v"), (7, "q r s t u v")]
    # one line repeated often weighs as one line
    rows += [(8, " ".join(words[::-1])), (9, " ".join(words[::-1]) + " a b c d e" * 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = simhash.similar_representatives(docs, block=4).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(["100", "1", "3", "5", "None", "None", "7", "8"])
    assert simhash.similar_representatives(docs.limit(0)).count() == 0


def test_the_given_documents_equal_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], shingles(r["text"] or "")) for r in docs.collect()]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(rows):
        for j, b in rows[n + 1 :]:
            if a == b or len(a & b) >= 0.8 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    want = sorted(i for i in root if find(i) == i)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == want
