"""Wide to long, long to wide, constant columns, unions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions.fixed_values import VALUE_METRICS
from areascore.functions.times import iso_date, month_of

MONTH_COLUMN = re.compile(r".{4}-.{2}-.{2}")


def stamp(df: DataFrame, **literals) -> DataFrame:
    """Add constant columns; one value for the whole batch."""
    return df.withColumns({name: F.lit(value) for name, value in literals.items()})


def batch_time() -> datetime:
    """UTC wall time in whole seconds, taken once per batch."""
    return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)


def stamp_ingested(df: DataFrame, now: datetime | None = None) -> DataFrame:
    moment = (now or batch_time()).strftime("%Y-%m-%d %H:%M:%S")
    return df.withColumn("ingested_at", F.lit(moment).cast("timestamp_ntz"))


def month_columns(df: DataFrame) -> list[str]:
    """Columns named like ``2024-01-31``."""
    return [c for c in df.columns if MONTH_COLUMN.fullmatch(c)]


def unpivot_months(df: DataFrame, id_cols: Sequence[str], metric: str) -> DataFrame:
    """One row per area and month from one column per month; missing values are dropped.

    Raises when there is no month column, since the file layout must have changed.
    """
    months = month_columns(df)
    if not months:
        raise ValueError(f"{metric}: no month columns among {df.columns}")
    slim = df.select(*id_cols, *(F.col(f"`{m}`").cast("double").alias(m) for m in months))
    long = slim.unpivot(list(id_cols), [f"`{m}`" for m in months], "period_month", "value")
    return long.dropna(subset=["value"]).withColumns(
        {"period_month": iso_date(F.col("period_month")), "metric_type": F.lit(metric)}
    )


def pivot_metrics(
    df: DataFrame,
    values: Sequence[str] = tuple(VALUE_METRICS),
    key: str = "zip_code",
    month: str = "period_month",
    metric: str = "metric_type",
    value: str = "value",
) -> DataFrame:
    """One row per area and month, one column per known metric.

    Conditional maxima combine on the map side, so a hot area leaves each task as one row
    per month; the list of values is given, so no extra pass looks for it.
    """
    return df.groupBy(key, month_of(F.col(month)).alias("period_month")).agg(
        *(F.max(F.when(F.col(metric) == v, F.col(value))).alias(v.lower()) for v in values)
    )


def unpivot_freshness(audit: DataFrame, prefix: str = "freshness_") -> DataFrame:
    """(source, status) rows from the freshness columns of an audit row."""
    cols = [c for c in audit.columns if c.startswith(prefix)]
    long = audit.unpivot([], cols, "source", "status")
    return long.withColumn("source", F.col("source").substr(F.lit(len(prefix) + 1), F.length("source")))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
