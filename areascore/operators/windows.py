"""Latest row per key, deduplication, whole-table statistics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from areascore.functions.times import month_of

Order = str | Column


def _first_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows numbered 1. Spark limits each map task to one row per key before the shuffle,
    so a key that holds most of the table still sends one row per task."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_per(df: DataFrame, keys: Sequence[str], order: str, tie: Sequence[Order] = ()) -> DataFrame:
    """The row with the highest ``order`` per key; ``tie`` makes the choice total."""
    ties = [F.col(t).asc_nulls_last() if isinstance(t, str) else t for t in tie]
    return _first_of(df, keys, [F.col(order).desc_nulls_first(), *ties])


def dedup(df: DataFrame, keys: Sequence[str], tie: Sequence[Order]) -> DataFrame:
    """One row per key, picked by ``tie``."""
    return _first_of(df, keys, [F.col(t).asc_nulls_last() if isinstance(t, str) else t for t in tie])


def latest_month_rows(df: DataFrame, key: str, date: str) -> DataFrame:
    """All rows of the latest calendar month of each key.

    The latest months come from a pass over two columns that combines on the map side and
    leaves one row per key. What follows, medians above all, then works on one month instead
    of the whole history.
    """
    last = df.groupBy(key).agg(month_of(F.max(date)).alias("_last"))
    return df.join(last, key).filter(month_of(F.col(date)) == F.col("_last")).drop("_last")


def argmax_by(df: DataFrame, key: str, value: str, tie: Sequence[Order] = ()) -> DataFrame:
    """The row with the largest ``value`` per key, ties by ``tie``."""
    ties = [F.col(t).asc_nulls_last() if isinstance(t, str) else t for t in tie]
    return _first_of(df, [key], [F.col(value).desc_nulls_last(), *ties])


def global_stats(
    df: DataFrame, cols: Sequence[str], means: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """One row, one struct: min, max, mean and zero-filled minimum of each column."""
    means = means or {}
    fields = []
    for c in cols:
        fields += [
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
            means.get(c, F.avg)(F.col(c)).alias(f"{c}_avg"),
            F.min(F.coalesce(F.col(c), F.lit(0))).alias(f"{c}_min0"),
        ]
    return df.agg(F.struct(*fields).alias("stats"))


def with_global_stats(
    df: DataFrame, cols: Sequence[str], means: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """Add the struct ``stats`` to every row.

    The statistics are a scalar subquery: partial aggregates combine on the map side, one row
    comes back and is used as a constant. No task sees the whole table and nothing is joined.
    """
    return df.withColumn("stats", global_stats(df, cols, means).scalar())
