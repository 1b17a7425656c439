"""Shards of near equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.llm.common import running

#: Bytes that each document counts besides its text.
OVERHEAD = 16


def shard(
    docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text", overhead: int = OVERHEAD
) -> DataFrame:
    """One row per document with its shard (0 to ``shards`` - 1) and its slot there (gapless from 0).

    Documents stand in one global order: digest of the text, then key, so that equal texts are neighbours.
    The bytes before a document come from the totals of the ranges before its own and the running sum in
    its range; the document goes to the shard in whose equal part of all bytes its middle lies. Shards are
    contiguous in that order and miss an equal part by at most half a document at either end.

    Only key, size and checksums are shuffled, never texts. A null text counts as empty, a null key sorts
    first, rows equal in key and text are interchangeable, an empty table gives no rows; other columns
    are ignored. Fewer documents than shards leave some shards empty.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.md5(F.col(text).cast("binary")).alias("_text"),
    )
    order = [F.col("_text"), F.col("doc_id"), F.col("size")]
    placed = running(rows, order, {"bytes": F.col("size")})
    placed = placed.withColumn("shard", F.expr(f"int(((2 * bytes_before + size) * {int(shards)}) div (2 * bytes_total))"))
    first = placed.groupBy("shard").agg(F.min("row_before").alias("_first"))
    return placed.join(first, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row_before") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
