"""Token files against the library, row by row, and what the files look like inside."""

import glob
import random
import struct
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from areascore.llm import queries, tokens

ROWS = [
    (5, "Five five <|endoftext|> here"), (1, "one"), (1, "one"), (1, "another text"), (None, "no key"), (3, None), (2, ""),
    (9, "word " * 60_000), (7, "x" * 70_000), (-4, "Zwölf 😀 Boxkämpfer\n\n  écrit"), (2**40, " \t\n "),
]


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_path())
    t.no_padding()
    t.no_truncation()
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.withColumn("tokens", F.lit(1)).withColumn("part", F.lit("p")).withColumn("start", F.lit(0))


def wanted(rows, encode):
    out, start = [], 0
    for i, t in rows:
        ids = encode(t)
        out.append((i, start, len(ids), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files_hold_the_librarys_ids_in_order(spark, odd, encode, tmp_path, encoding):
    tokens.write_tokens(odd, f"{tmp_path}/t", encoding=encoding, row_group=1 << 16, page_rows=3)
    got = sorted(map(tuple, tokens.read_documents(spark, f"{tmp_path}/t").collect()), key=lambda r: r[1])
    keys = [r[0] for r in got]
    assert keys == [None, -4, 1, 1, 1, 2, 3, 5, 7, 9, 2**40]
    at = 0
    for _, start, n, ids in got:
        assert start == at and n == len(ids)
        at += n
    assert sorted(((k, ids) for k, _, _, ids in got), key=repr) == sorted(((k, encode(t)) for k, t in ROWS), key=repr)
    flat = np.concatenate([r[3] for r in got])
    for begin, end in ((0, 1), (3, 40), (100, 70_000), (0, at), (at - 2, at + 5), (at, at + 1), (7, 7)):
        met = sorted(map(tuple, tokens.read_span(spark, f"{tmp_path}/t", begin, end).collect()), key=lambda r: r[1])
        assert [x for r in met for x in r[2]] == flat[begin:end].tolist()
        assert not met or met[0][1] == begin
    chosen = tokens.read_documents(spark, f"{tmp_path}/t", 2, 7, tokens=False)
    assert sorted(r["doc_id"] for r in chosen.collect()) == [2, 3, 5, 7] and chosen.columns == ["doc_id", "start", "n_tokens"]
    for file in glob.glob(f"{tmp_path}/t/tokens/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                assert column.has_offset_index and column.has_column_index, column.path_in_schema
                used = [e for e in column.encodings if "DICT" in e]
                assert bool(used) == (encoding == "dictionary" and column.path_in_schema.startswith("tokens"))
                if not used and column.physical_type in ("INT32", "INT64"):
                    assert "DELTA_BINARY_PACKED" in column.encodings


def test_row_groups_keep_their_size(spark, tmp_path):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.expr("repeat(concat(md5(string(id)), ' '), 60)").alias("text")).coalesce(1)
    tokens.write_tokens(docs, f"{tmp_path}/t", encoding="delta", row_group=1 << 18)
    groups = [pq.ParquetFile(f).metadata for f in glob.glob(f"{tmp_path}/t/tokens/*.parquet")]
    assert sum(m.num_row_groups for m in groups) >= 4
    assert all(m.row_group(g).total_byte_size <= 2 << 18 for m in groups for g in range(m.num_row_groups))


def test_a_filter_and_a_choice_of_columns_reach_the_scan(spark, odd, tmp_path):
    tokens.write_tokens(odd, f"{tmp_path}/t")
    plan = tokens.read_documents(spark, f"{tmp_path}/t", 2, 7, tokens=False)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,2)" in plan and "LessThanOrEqual(doc_id,7)" in plan and "tokens:array" not in plan


def test_empty_table_and_encoding(spark, odd, tmp_path):
    tokens.write_tokens(odd.limit(0), f"{tmp_path}/t")
    assert tokens.read_documents(spark, f"{tmp_path}/t").count() == 0
    assert tokens.read_span(spark, f"{tmp_path}/t", 0, 10).count() == 0
    with pytest.raises(ValueError):
        tokens.write_tokens(odd, f"{tmp_path}/u", encoding="plain")


def test_query_equals_the_library(spark, encode):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    want = [(i, s, n, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))) for i, s, n, ids in wanted(docs, encode)]
    got = queries.QUERIES["op11_tokens"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_words_one_by_one_equal_whole_texts(encode):
    rng = random.Random(3)
    parts = ["a", "Don't", "'s", "''s", " ", "  ", "\t", "\x1c", "\x85", "\xa0", "é", "½", "²", "<|endoftext|>", "<|end", "😀", "中文", "​", "!!", "\x00",
             "\n\n ", "क्", "͸", "ﬁ", "z" * 80, "12a3", "\U0001e5f0", "_", "…"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    with open(tokens.default_path(), encoding="utf-8") as file:
        own = tokens.Encoder(file.read())
    got = [x for piece in tokens._pieces(texts) for x in own(piece)]
    assert got == [struct.pack(f"<{len(ids)}I", *ids) for ids in (encode(t)[:-1] for t in texts)]


def test_every_code_point_is_put_like_the_library(encode):
    with open(tokens.default_path(), encoding="utf-8") as file:
        own = tokens.Encoder(file.read())
    texts = ["".join(f"a{chr(c)}1 {chr(c)}!" for c in range(at, min(at + 64, 0x30000)) if not 0xD800 <= c < 0xE000) for at in range(0, 0x30000, 64)]
    assert own(texts) == [struct.pack(f"<{len(ids)}I", *ids) for ids in (encode(t)[:-1] for t in texts)]


def packed(texts, encode):
    return [struct.pack(f"<{len(ids)}I", *ids) for ids in (encode(t)[:-1] for t in texts)]


@pytest.fixture
def own():
    with open(tokens.default_path(), encoding="utf-8") as file:
        return tokens.Encoder(file.read())


def test_words_met_again_are_not_encoded_again_when_the_memory_is_full(own, encode, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    blocks = [[" ".join(["often", *(f"{chr(97 + i)}x{j}y" for j in range(10))])] for i in range(12)]
    asked, word = [], own._word
    monkeypatch.setattr(own, "_word", lambda tokenize, w: asked.append(w) or word(tokenize, w))
    assert [x for b in blocks for x in own(b)] == packed([t for b in blocks for t in b], encode)
    assert asked.count("often") == 1 and len(own.known) + len(own.before) < 120


def test_long_texts_are_cut_before_words(own, encode, monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 40)
    texts = ["it's a'll  b'ree \n x'sd ''t'm é 12 a' s" * 20, "x" * 500, "a b " * 99 + "<|endoftext|>", "", "a b\xa0 c" * 60, "don't"]
    assert len(list(tokens._parts(texts[0]))) > 5
    assert own(texts) == packed(texts, encode)


def test_different_words_with_one_hash_stay_apart(own, encode, monkeypatch):
    monkeypatch.setattr(own, "_hashes", lambda points, start, end: (end - start).astype(np.uint64))
    texts = ["one two six", "ten", "", "one"]
    assert own(texts) == packed(texts, encode)


def test_endings_behind_apostrophes(own, encode):
    rng = random.Random(8)
    texts = ["".join(rng.choice("'stmdrevl' \n1!é") for _ in range(rng.randint(0, 9))) for _ in range(20_000)]
    assert own(texts) == packed(texts, encode)
