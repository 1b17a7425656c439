"""Counts per area over fixed windows, with an allowance for late records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from areascore.functions.times import year_of

LATENESS = "30 days"


def tumbling_counts(df: DataFrame, ts: str, key: str, width: str, out: str = "n") -> DataFrame:
    """Batch twin of ``stream_counts``."""
    return (
        df.groupBy(F.window(F.col(ts), width).alias("w"), key)
        .agg(F.count(F.lit(1)).alias(out))
        .select(F.col("w.start").alias("window_start"), key, out)
    )


def stream_counts(stream: DataFrame, ts: str, key: str, lateness: str = LATENESS, width: str = LATENESS) -> DataFrame:
    """Append-mode counts: a window is emitted once no record that late can arrive any more.

    Late records within the allowance are counted. Calendar years are no fixed windows, so
    roll the result up with ``yearly_from_windows`` in batch when ``width`` divides days.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return tumbling_counts(timed.withWatermark(ts, lateness), ts, key, width)


def yearly_from_windows(counts: DataFrame, key: str, out: str = "n") -> DataFrame:
    """Calendar-year totals from one-day windows."""
    return counts.groupBy(key, year_of(F.col("window_start")).alias("year")).agg(F.sum(out).alias(out))


def run_counts(
    spark: SparkSession, source: str, out: str, checkpoint: str, schema: StructType, ts: str, key: str,
    lateness: str = LATENESS, width: str = LATENESS,
) -> None:
    """Count the files of ``source`` that came since the last run, append the windows that closed to ``out``, and stop.

    The watermark and open windows are in ``checkpoint``: what a run leaves open a later one closes.
    """
    counts = stream_counts(spark.readStream.schema(schema).parquet(source), ts, key, lateness, width)
    writer = counts.writeStream.outputMode("append").format("parquet").option("path", out)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
