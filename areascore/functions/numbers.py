"""Numeric expressions: guarded division, rates, casts of raw text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Rounding = Callable[[Column, int], Column]


def floor_round(col: Column, digits: int) -> Column:
    """Round half up on the binary value, the same on every engine that has IEEE doubles."""
    scale = float(10**digits)
    return F.floor(col * scale + 0.5) / scale


def divide(top: Column, bottom: Column) -> Column:
    """Division that is null, not an error, on a zero divisor."""
    return top / F.nullif(bottom, F.lit(0))


def per_1k(n: Column, population: Column, digits: int = 2, rounding: Rounding = F.round) -> Column:
    return rounding(divide(n, population) * 1000, digits)


def ratio(top: Column, bottom: Column, digits: int = 4, rounding: Rounding = F.round) -> Column:
    return rounding(divide(top, bottom), digits)


def months_of_supply(inventory: Column, sold: Column) -> Column:
    return divide(inventory, sold)


def exact_mean(col: Column, scale: int = 2) -> Column:
    """Mean of fixed-scale values through a decimal sum, so it does not depend on row order."""
    return F.sum(col.cast(f"decimal(28,{scale})")).cast("double") / F.count(col)


def null_if_sentinel(col: Column, sentinel: str) -> Column:
    """The feed's missing mark becomes null; anything else must parse as a number."""
    return F.nullif(col, F.lit(sentinel)).cast("double")


def to_double(col: Column, lenient: bool = False) -> Column:
    return col.try_cast("double") if lenient else col.cast("double")
