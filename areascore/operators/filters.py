"""Row filters. Each is one predicate, so Catalyst can push it into the scan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areascore.functions.fixed_values import SCORING_VINTAGE


def keep_state(df: DataFrame, col: str, code: str) -> DataFrame:
    return df.filter(F.col(col) == code)


def in_code_range(df: DataFrame, col: str, low: int, high: int) -> DataFrame:
    """Inclusive range on a code stored as text; text that is no number is dropped."""
    return df.filter(F.col(col).try_cast("int").between(low, high))


def keep_codes(df: DataFrame, col: str, codes: Sequence) -> DataFrame:
    return df.filter(F.col(col).isin(list(codes)))


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & (F.col(col) != ""))


def drop_all_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep a row when at least one of ``cols`` has a value."""
    return df.filter(any_present(cols))


def any_present(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(c).isNotNull() for c in cols))


def drop_sentinel(df: DataFrame, col: str, sentinel: str) -> DataFrame:
    return df.filter(F.col(col) != sentinel)


def newer_than(df: DataFrame, col: str, watermark: str | None = None) -> DataFrame:
    """Rows strictly after the high-water mark; all rows when there is none."""
    return df if watermark is None else df.filter(F.col(col) > F.lit(watermark).cast("date"))


def newer_versions(df: DataFrame, col: str, watermark: int | str | None = None) -> DataFrame:
    return df if watermark is None else df.filter(F.col(col) > int(watermark))


def from_bound(df: DataFrame, col: str, bound: str) -> DataFrame:
    """Rows at or after an inclusive lower bound; the bound takes the type of the column."""
    return df.filter(F.col(col) >= F.lit(bound).cast(df.schema[col].dataType))


def valid_sales(df: DataFrame, col: str = "valid_sale") -> DataFrame:
    return df.filter(F.col(col) == "Y")


def exclude_value(df: DataFrame, col: str, value: str) -> DataFrame:
    return df.filter(F.col(col) != value)


def pin_vintage(df: DataFrame, year: int = SCORING_VINTAGE, col: str = "vintage_year") -> DataFrame:
    return df.filter(F.col(col) == year)


def positive_only(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) > 0)


def one_area(df: DataFrame, zip_code, col: str = "zip_code") -> DataFrame:
    return df.filter(F.col(col) == zip_code)
