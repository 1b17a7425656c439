"""Samples, steps and groups at sizes that used to meet a cap or one task."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from areascore.llm import langid, mixing, toxicity


def test_every_window_of_sixty_languages_is_seen(monkeypatch):
    seen = Counter()
    gradients = langid.Network.gradients

    def counted(self, x, y):
        seen.update(y.tolist())
        return gradients(self, x, y)

    monkeypatch.setattr(langid.Network, "gradients", counted)
    names = [f"l{i:02d}" for i in range(60)]
    rng = np.random.default_rng(1)
    x = rng.integers(0, 256, (60 * 40, langid.WINDOW), dtype=np.uint8)
    y = np.repeat(np.arange(60), 40)
    langid.Network(names).fit(x, y, epochs=2, batch=4)
    assert set(seen) == set(range(60)) and min(seen.values()) == max(seen.values()) == 80


def test_a_large_language_is_thinned_before_it_is_ranked(spark, monkeypatch):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("some words of "), F.col("id")).alias("text"),
        F.when(F.col("id") % 1000 == 0, "rare").otherwise("often").alias("lang"),
    )
    fitted = {}
    monkeypatch.setattr(langid.Network, "fit", lambda self, x, y: fitted.update(Counter(np.array(self.languages)[y].tolist())))
    langid.train(docs, rows_per_language=50, windows_per_row=2)
    assert fitted == {"often": 100, "rare": 60}


def test_a_small_sample_of_many_labels_still_learns(spark):
    docs = spark.range(40_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "you rotten scoundrel").otherwise("a fine day outside").alias("text"),
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels, sample_rows=400)
    assert model.weights and "fine" not in model.weights
    low, high = toxicity.score(spark.createDataFrame([(1, "a fine day"), (2, "rotten scoundrel")], "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert low["predicted"] == 0 and high["predicted"] == 1


def test_many_equal_rows_without_keys_meet_one_use_each(spark):
    rows = [(None, "the same words again", "a", i) for i in range(10_000)] + [(i, f"text number {i}", "b", i) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other long")
    used = mixing.training_order(docs)
    plan = used._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    out = Counter(r["other"] for r in used.filter("source = 'a'").collect())
    mixed = mixing.mix(docs).filter("source = 'a'").groupBy(F.size("positions").alias("n")).count().collect()
    assert Counter(out.values()) == {r["n"]: r["count"] for r in mixed if r["n"]}
    singles = Counter(r["doc_id"] for r in used.filter("source = 'b'").collect())
    want = {r["doc_id"]: len(r["positions"]) for r in mixing.mix(docs).filter("source = 'b'").collect() if r["positions"]}
    assert singles == want
