"""Incremental run over a landing folder of fetches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from areascore.plans.ingest import COMPLETE, complete_fetches, ingest_feed

MARKER = StructType([StructField("value", StringType()), StructField("load", StringType())])


def run_incremental(
    spark: SparkSession, landing: str, table_dir: str, checkpoint: str, state: str, source: str = "crime"
) -> None:
    """Load every fetch that was completed since the last run, then stop.

    The stream reads completion markers, not pages: a fetch whose pages are still landing is not
    seen, and once its marker is there all its pages are read, whenever they landed. The fetches of a
    batch are applied in one plan. A batch that is replayed finds its fetches in the log of applied
    ones, or replaces the same range by the same rows.
    """

    def apply(markers: DataFrame, _batch_id: int) -> None:
        ingest_feed(spark, source, landing, table_dir, state, complete_fetches(markers))

    stream = spark.readStream.schema(MARKER).option("pathGlobFilter", COMPLETE).text(landing)
    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
