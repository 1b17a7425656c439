"""Fill-in-middle against a plain split by the token pattern."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from areascore.llm import middle

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    t = TOKEN.findall(text)
    h = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(t)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(t[:a]), "".join(t[a:b]), "".join(t[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 80 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h[3] % 100 < 80 else "psm", len(p), len(m), out


def texts():
    rng = random.Random(5)
    parts = ["a", "bc ", " ", "\n", "\t\x0b", "é", "😀", "\xa0", "<", "<P", ">", "M>", "word word", "中文 ", "\x00", "\x85"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 200))) for _ in range(400)]
    shared = " ".join(f"w{rng.randrange(900)}" for _ in range(6000))
    out += [f"{rng.random()} {shared[rng.randrange(9000):]} {i}" for i in range(12)]
    out += [" " * 40_000, "x" * 40_000, "é" * 30_000, "a " * 30_000, "x<P>y", "<S>", "q <M> r", "😀 " * 9000, "", " ", "one"]
    return out


def test_output_and_restored_text(spark):
    given = [*enumerate(texts(), 10)]
    rows = [*given, (None, "no key at all"), (3, None), (3, None), *given[:3]]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("output", F.lit("o"))
    out = middle.fill_in_middle(df)
    out = out.withColumn("back", middle.restored()).collect()
    want = [(i, *(plain(i, t or "") if i is not None else (len(TOKEN.findall(t)), "plain", None, None, t)), t or "") for i, t in rows]
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    assert middle.fill_in_middle(df.limit(0)).count() == 0


@pytest.mark.parametrize("k", range(0, 40))
def test_every_cut_of_texts_in_many_chunks(monkeypatch, k):
    monkeypatch.setattr(middle, "LEAST", 1)
    monkeypatch.setattr(middle, "MOST", 3 + k % 5)
    monkeypatch.setattr(middle, "SECTION", 16)
    rng = random.Random(k)
    text = "".join(rng.choice(["a", " ", "é", "\n", "xy", "😀", "  "]) for _ in range(k * 3))
    raw, chunks, t = text.encode(), middle.Chunks(), TOKEN.findall(text)
    doc = middle.Document(raw, chunks)
    assert doc.n == len(t)
    for i in range(len(t) + 1):
        want = "".join(t[:i])
        assert doc.cut(i) == (len(want.encode()), len(want))


def test_shared_passages_share_chunks_and_collisions_do_no_harm(monkeypatch):
    rng = random.Random(1)
    passage = " ".join(f"w{rng.randrange(5000)}" for _ in range(4000)).encode()
    chunks = middle.Chunks()
    middle.Document(b"one beginning " + passage, chunks)
    before = chunks.reused
    n = len(middle.chunk_ends(passage))
    middle.Document(b"quite another start " + passage + b" and end", chunks)
    assert chunks.reused - before >= n - 3 > 5
    monkeypatch.setattr(middle.xxhash, "xxh3_64_intdigest", lambda c: 1)
    same = middle.Chunks()
    for text in texts()[:50]:
        assert middle.Document(text.encode(), same).n == len(TOKEN.findall(text))
    small = middle.Chunks(most=300)
    for text in texts()[:50]:
        assert middle.Document(text.encode(), small).n == len(TOKEN.findall(text)) and small.held <= 300 + 20_000
