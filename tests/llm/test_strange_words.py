"""Texts that have none of their language's common words."""

import re
from collections import Counter

from pyspark.sql import functions as F

from areascore.llm import quality


def test_texts_without_common_words_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    counts = {}
    for r in docs.collect():
        counts.setdefault(r["lang"], Counter()).update((r["text"] or "").lower().split())
    rows = []
    for lang in sorted(x for x in counts if x):
        rare = [w for w, _ in counts[lang].most_common(1500)[100:] if w.isalpha()]
        rows += [(-len(rows) - 1, " ".join(rare[:60]), lang), (-len(rows) - 2, " ".join(rare[:200]), lang)]
    found = quality.assess(docs.union(spark.createDataFrame(rows, "doc_id long, text string, lang string")).coalesce(4))
    by = {r["doc_id"]: r for r in found.filter("doc_id < 0").collect()}
    assert len(by) == len(rows) == 8
    assert [tuple(r) for r in by.values() if r["kept"] or r["base_failed"] or r["word_distance"] <= quality.WORD_LIMIT] == []


def test_listed_words_are_whole_and_taken_as_they_are(spark):
    listed = ["the", "a.b", "the.", "|", "\\e", "x\\ey", "*", "é"]
    texts = ["the theme a.b axb\tthe.\x0bthe | || \\E x\\Ey * ** É the", "", "bathe the", " the the  the"]
    rows = [(i, t.lower(), listed) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, lower string, listed array<string>")
    coded = df.select("i", quality.coded_words("lower", "listed", 8).alias("c")).collect()
    want = ["".join(chr(256 + listed.index(w)) for w in re.findall(r"[^\x20\x09-\x0D]+", t) if w in listed) for _, t, _ in rows]
    assert [r["c"] for r in sorted(coded)] == want and len(want[0]) == 10


def test_signs_leave_all_but_space(spark):
    text = "aB 1\t.\n#\x0b@\x0c\r é \x00\x1c😀"
    row = spark.createDataFrame([(text,)], "t string").select(quality.signs(F.col("t")).alias("s")).first()
    assert row["s"] == "vK0.#@é \x00\x1c😀"
