"""From raw documents to tokens: language, near-duplicates, personal data, mixing, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of ``documents``.
Null, empty and very long texts, repeated rows, empty tables and further columns behave as the operators
say: documents without letters are rejected by the first stage, so are null texts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from areascore.llm import bpe, langid, mixing, pii, simhash
from areascore.session import ensure_checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters or below the least score go."""
    return langid.known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest key of each group of near-duplicates: texts whose sets of five-word shingles have a
    Jaccard similarity of 0.8 or more. Candidates are compared exactly."""
    return simhash.similar_representatives(docs, shingle=5, radius=5, least=0.8)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix uses, as often as it uses them, in training order."""
    return mixing.training_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every use."""
    return bpe.encode(docs)


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing", mixture),
    ("BPE", tokens),
]

#: Network, hashes and merges aren't expressible in SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; what a stage returns is written to the shared folder."""
    ensure_checkpoint_dir(spark)
    shared = spark.sparkContext.getCheckpointDir()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            folder = f"{shared}/pipeline-{uuid.uuid4().hex}/{i}"
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
