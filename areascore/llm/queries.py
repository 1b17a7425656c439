"""One registered query per operator, over whole tables, with a SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areascore.llm import bpe, embeddings, langid, middle, mixing, pii, quality, search, sharding, simhash, sql, suffixes, tokens, toxicity
from areascore.llm.common import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    if fn.__name__ in sql.ORACLES:
        ORACLES[fn.__name__] = sql.ORACLES[fn.__name__]
    return fn


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.order_by_position(mixing.mix(table(spark, sf_dir, "documents")))
    # the time of the first use, rounded for the comparison with SQL
    first = F.round(F.get("positions", F.lit(0)), 9).alias("position")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", first)


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


@query
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


@query
def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query
def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), folder)
    return tokens.with_crc32(tokens.read_documents(spark, folder))


@query
def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(middle.restored(), 256).alias("restored_sha256")
    return moved.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
