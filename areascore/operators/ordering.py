"""Sorted output and top-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areascore.session import settle


def ordered(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*cols)


def with_places(df: DataFrame, out: str = "place") -> DataFrame:
    """The rows of an ordered frame with the place (from 1) that each comes out at.

    A row knows its number inside its partition; the rows of the partitions before it come from one count a
    partition. So no task sees more than its own range, and the table is sorted once.
    """
    first = F.shiftleft(F.spark_partition_id().cast("long"), 33)  # the ids of a partition ascend from here
    came = settle(df.withColumns({"_part": F.spark_partition_id(), "_nth": F.monotonically_increasing_id() - first + 1}))
    sizes = came.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = came.join(F.broadcast(before), "_part")  # one row a partition
    return placed.select(*df.columns, (F.col("_before") + F.col("_nth")).alias(out))


def top_n(df: DataFrame, col: str, n: int, tie: Sequence[str] = ("zip_code",)) -> DataFrame:
    """The ``n`` rows with the highest ``col``; each task keeps its own ``n`` before merging."""
    return df.orderBy(F.col(col).desc_nulls_last(), *tie).limit(n)


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).dropna().distinct().orderBy(col)
