"""Scoring expressions. ``stats`` is the one-row struct made by ``operators.windows.global_stats``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from areascore.functions.fixed_values import NEUTRAL_SCORE, SIGNALS
from areascore.functions.numbers import Rounding, divide


def minmax_score(
    col: str,
    stats: Column,
    direction: str = "direct",
    impute: str | None = None,
    floor0: bool = False,
    digits: int = 2,
    rounding: Rounding = F.round,
) -> Column:
    """Min-max score on 0-100; null when every value is the same.

    ``impute='mean'`` gives areas without a value the mean of those that have one.
    ``floor0`` subtracts the minimum taken with missing values as 0, while the spread below
    the line still uses the true minimum; the worst area can then fall under 0.
    """
    low, high = stats[f"{col}_min"], stats[f"{col}_max"]
    value = F.col(col)
    if impute == "mean":
        value = F.coalesce(value, stats[f"{col}_avg"])
    base = stats[f"{col}_min0"] if floor0 else low
    share = divide(value - base, high - low)
    if direction == "inverted":
        share = 1 - share
    elif direction != "direct":
        raise ValueError(f"unknown direction {direction!r}")
    return rounding(share * 100, digits)


def composite(
    scores: Sequence[str], default: float = NEUTRAL_SCORE, digits: int = 2, rounding: Rounding = F.round
) -> Column:
    """Plain mean of the scores, a missing one counting as ``default``."""
    total = F.coalesce(F.col(scores[0]), F.lit(float(default)))
    for name in scores[1:]:
        total = total + F.coalesce(F.col(name), F.lit(float(default)))
    return rounding(total / len(scores), digits)


def confidence(price: Column, crime_rate: Column) -> Column:
    return (
        F.when(price.isNull() & crime_rate.isNull(), "Low")
        .when(price.isNull() | crime_rate.isNull(), "Partial")
        .otherwise("High")
    )


def reweighted(
    weights: Mapping[str, float],
    signals: Mapping[str, str] = SIGNALS,
    default: float | None = None,
    digits: int = 2,
    rounding: Rounding = F.round,
) -> Column:
    """Weighted mean of the signal scores; 50 when all weights are 0, null when a score is null.

    ``default`` opts in to counting a missing score as that value.
    """
    whole = float(sum(weights.values()))
    if whole == 0:
        return F.lit(float(NEUTRAL_SCORE))
    total = None
    for signal, column in signals.items():
        score = F.col(column) if default is None else F.coalesce(F.col(column), F.lit(float(default)))
        term = score * F.lit(float(weights[signal]))
        total = term if total is None else total + term
    return rounding(total / whole, digits)
