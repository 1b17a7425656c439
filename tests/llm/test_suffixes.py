"""Removed passages against a dictionary of all windows."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from areascore.llm import suffixes


def plain(texts, window):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - window + 1):
            if seen[r[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return out


def got(df, **options):
    found = suffixes.remove_repeats(df, **options).withColumn("sha", F.sha2("kept", 256))
    rows = sorted(found.collect(), key=lambda r: r["doc_id"])
    return [(r["n_bytes"], r["n_removed"], r["n_spans"], r["sha"]) for r in rows]


def test_equals_all_windows_on_the_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = [r["text"] for r in df.orderBy("doc_id").collect()]
    want = plain(texts, 400)
    assert got(df) == want and sum(w[1] for w in want) > 0


@pytest.mark.parametrize("frequent", [0, 3, 4000])
@pytest.mark.parametrize("block", [500, 1 << 20])
def test_small_windows_over_copies_periods_and_shared_passages(spark, frequent, block):
    rng = random.Random(frequent + block)
    word = lambda n: "".join(rng.choice("abé \n") for _ in range(n))
    passage, texts = word(60), [None, "", "a" * 200, "ab" * 90, "x", word(500), word(9)]
    texts += [word(rng.randint(0, 50)) + passage[: rng.randint(20, 60)] + word(rng.randint(0, 50)) for _ in range(40)]
    texts += [texts[5], texts[5][100:], texts[10], texts[10]] + [word(30) * 3 for _ in range(3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert got(df, window=24, anchor=8, frequent=frequent, block=block) == plain(texts, 24)


@pytest.mark.parametrize("size, gone", [(394, 0), (399, 0), (400, 400), (1000, 1000)])
def test_bytes_and_not_words_decide_on_a_shared_passage(spark, size, gone):
    rng = random.Random(size)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(200))[: size - 1] + "."
    assert len(passage.split()) > 50
    texts = [" ".join(word() for _ in range(90)) + edge + passage + edge + " ".join(word() for _ in range(90)) for edge in "<>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r[1:3] for r in got(df)] == [(gone, int(gone > 0))] * 2


def test_long_texts_are_cut_without_losing_windows(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    rng = random.Random(5)
    long = "".join(rng.choice("abc") for _ in range(5000))
    texts = [long, "zz" + long[1000:3000], long[2500:2600]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    finder = suffixes.Anchors(40, 16)
    cut = sum(n.sum() for _, _, n, _, _ in finder.segments([t.encode() for t in texts]))
    assert cut == sum(len(t) - 39 for t in texts)
    assert got(df, window=40, anchor=16) == plain(texts, 40)


def test_empty_table_null_keys_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, "q" * 900, 1, 2), (None, None, 1, 2)], "doc_id long, text string, raw int, d1 int")
    assert sorted(r["n_removed"] for r in suffixes.remove_repeats(df).collect()) == [0, 900]
    assert suffixes.remove_repeats(df.limit(0)).count() == 0
