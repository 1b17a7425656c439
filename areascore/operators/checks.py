"""Data-quality checks. A check returns the violating rows; it passes when there are none."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areascore.operators.aggregates import summarise_checks
from areascore.operators.reshape import union_all

__all__ = [
    "check_accepted", "check_coverage", "check_freshness", "check_grain", "check_not_null",
    "check_null_budget", "check_range", "check_unique", "run_checks", "summarise_checks",
]


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in cols)))


def check_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once; counts combine before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Repeated values; nulls do not count."""
    return check_grain(df.filter(F.col(col).isNotNull()), [col])


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(col).isin(list(values)))


def check_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    return df.filter((F.col(col) < low) | (F.col(col) > high))


def check_null_budget(df: DataFrame, col: str, budget: int) -> DataFrame:
    """One row with the number of nulls when it is over budget."""
    return df.agg(F.count_if(F.col(col).isNull()).alias("null_count")).filter(F.col("null_count") > budget)


def check_freshness(df: DataFrame, col: str, warn: float, error: float, now: datetime | str) -> DataFrame:
    """One row: latest load, age in days, pass, warn or error. An empty source is an error."""
    moment = F.lit(str(now)).cast("timestamp_ntz")
    latest = df.agg(F.max(F.col(col).cast("timestamp_ntz")).alias("latest"))
    age = F.timestamp_diff("SECOND", F.col("latest"), moment) / 86400
    return latest.withColumn("age_days", age).withColumn(
        "status",
        F.when(F.col("age_days").isNull() | (F.col("age_days") > error), "error")
        .when(F.col("age_days") > warn, "warn")
        .otherwise("pass"),
    )


def check_coverage(df: DataFrame, expected: DataFrame, key: str, share: float = 0.9) -> DataFrame:
    """One row with expected and missing areas when fewer than ``share`` are present."""
    return coverage(df, expected, key, share).filter("status = 'warn'")


def coverage(df: DataFrame, expected: DataFrame, key: str, share: float = 0.9) -> DataFrame:
    present = df.select(key).distinct().withColumn("_here", F.lit(1))
    counted = expected.select(key).distinct().join(present, key, "left").agg(
        F.count(F.lit(1)).alias("expected"), F.count_if(F.col("_here").isNull()).alias("missing")
    )
    here = F.col("expected") - F.col("missing")
    return counted.withColumn("status", F.when(here < F.col("expected") * share, "warn").otherwise("pass"))


def run_checks(
    table: str,
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
    grains: Sequence[Sequence[str]] = (),
    ranges: Mapping[str, tuple[float, float]] | None = None,
    null_budgets: Mapping[str, int] | None = None,
) -> DataFrame:
    """(check, violations, status) rows. All row-level checks of a table share one pass."""
    single: dict[str, Column] = {}
    for c in not_null:
        single[f"{table}.{c} not null"] = F.count_if(F.col(c).isNull())
    for c, values in (accepted or {}).items():
        single[f"{table}.{c} accepted"] = F.count_if(~F.col(c).isin(list(values)))
    for c, (low, high) in (ranges or {}).items():
        single[f"{table}.{c} range"] = F.count_if((F.col(c) < low) | (F.col(c) > high))
    for c, budget in (null_budgets or {}).items():
        nulls = F.count_if(F.col(c).isNull())
        single[f"{table}.{c} null budget"] = F.when(nulls > budget, nulls).otherwise(F.lit(0))
    parts = []
    if single:
        named = {f"c{i}": agg for i, agg in enumerate(single.values())}
        labels = F.create_map(*(F.lit(x) for pair in zip(named, single) for x in pair))
        wide = df.agg(*(agg.cast("bigint").alias(name) for name, agg in named.items()))
        parts.append(
            wide.unpivot([], list(named), "check", "violations").withColumn("check", labels[F.col("check")])
        )
    for keys, rows in [*(([c], df.filter(F.col(c).isNotNull())) for c in unique), *((g, df) for g in grains)]:
        kind = "unique" if list(keys) in [[c] for c in unique] else "grain"
        parts.append(
            check_grain(rows, keys)
            .agg(F.count(F.lit(1)).alias("violations"))
            .select(F.lit(f"{table}.{'+'.join(keys)} {kind}").alias("check"), "violations")
        )
    return union_all(parts).withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise("fail"))
