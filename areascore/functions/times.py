"""Date and time expressions. All wall times are TIMESTAMP_NTZ, so no session zone is involved."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(col: Column) -> Column:
    return F.to_date(col, "yyyy-MM-dd")


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def from_epoch_ms_seconds(col: Column) -> Column:
    """Epoch milliseconds to a UTC wall time in whole seconds."""
    return F.timestamp_add("SECOND", (col / 1000).cast("bigint"), _epoch())


def from_epoch_ms_local(col: Column, zone: str) -> Column:
    """Epoch milliseconds to the wall time of ``zone``."""
    utc = F.timestamp_add("MILLISECOND", col.cast("bigint"), _epoch())
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def to_epoch_ms(col: Column) -> Column:
    """Milliseconds from a UTC wall time."""
    return F.timestamp_diff("MILLISECOND", _epoch(), col.cast("timestamp_ntz"))


def year_of(col: Column) -> Column:
    return F.year(col)


def month_of(col: Column) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(col, "MM")


def lookback_bound(watermark: str | None, days: int, default: str) -> str:
    """Inclusive lower bound of an incremental read: the stored mark minus ``days``.

    Keeps the shape of the mark: a plain date stays a date, a time stays a time.
    """
    if watermark is None:
        return default
    moved = datetime.fromisoformat(watermark) - timedelta(days=days)
    return moved.strftime("%Y-%m-%d" if len(watermark) == 10 else "%Y-%m-%dT%H:%M:%S")
