"""Toxic words whose letters are set apart, as the only evidence of a text."""

import time

from pyspark.sql import functions as F

from areascore.llm import langid, toxicity


def test_spaced_words_alone_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels.filter(~langid.held_out(F.col("doc_id"), 4, 2)))
    read = lambda text: toxicity.spaced_words(text, model.chars)
    assert read("i d i o t f o o l") == ["idiot", "fool"]
    assert read("m  o  r  o  n") == ["moron"] and read("m\no\nr\no\nn") == ["moron"] and read("i.d.i.o.t") == ["idiot"]
    toxic = ["you are a m o r o n", "i d i o t f o o l", "he said 'm o r o n' to us", 'the "i d i o t" there', "m  o  r  o  n",
             "i\nd\ni\no\nt", "so i - d - i - o - t", "(m.o.r.o.n)", "p a t h e t i c", "i d 1 o t", "an i d i o t", "such a m o r o n, p.a.t.h.e.t.i.c"]
    plain = ["a b c d e f", "u.s.a. and e.u.", "1 2 3 4 5 6 7", "x * y * z", "- - - - -", "* * * * *", "don't t h e", "at 10 o'clock, room 4a"]
    df = spark.createDataFrame([*enumerate(toxic + plain)], "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    missed = [t for i, t in enumerate(toxic) if found[i] < toxicity.LEAST_SCORE]
    wrong = [t for i, t in enumerate(plain, len(toxic)) if found[i] >= toxicity.LEAST_SCORE]
    assert (missed, wrong) == ([], [])


def test_long_runs_of_signs_take_linear_time():
    start = time.time()
    for text in ("*" * 20_000 + "x", "a " * 20_000 + "bc", "- " * 20_000, "*.* " * 5_000, "1 2 " * 5_000, " " * 20_000 + "a"):
        sum(1 for _ in toxicity.SPACED.finditer(text))
    assert time.time() - start < 5
