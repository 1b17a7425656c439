"""Equi-joins. No broadcast is forced on a side whose size is not bounded by what it is:
small files are picked up from their size on disk, derived sides by the adaptive planner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions.display import display_money, score_rgba
from areascore.functions.fixed_values import NEUTRAL_SCORE
from areascore.functions.numbers import Rounding, divide, per_1k
from areascore.operators.aggregates import HOT_ROWS, grouped_medians


def restrict_to(df: DataFrame, valid: DataFrame, key: str, df_key: str | None = None) -> DataFrame:
    """Rows whose area is on the list. A semi-join, so a repeated list entry repeats nothing."""
    return df.join(valid.select(F.col(key).alias(df_key or key)), df_key or key, "left_semi")


def with_region(census: DataFrame, regions: DataFrame, key: str = "zip_code") -> DataFrame:
    return census.join(regions, key, "inner")


def with_population(
    counts: DataFrame,
    demographics: DataFrame,
    key: str = "zip_code",
    n: str = "incident_count",
    rounding: Rounding = F.round,
) -> DataFrame:
    """Counts with population and rate per 1,000; areas without demographics drop out."""
    people = demographics.select(key, "total_population")
    return counts.join(people, key, "inner").withColumn(
        "incidents_per_1k", per_1k(F.col(n), F.col("total_population"), rounding=rounding)
    )


def join_valuation(market: DataFrame, pivot: DataFrame, key: str = "zip_code") -> DataFrame:
    return market.join(pivot, [key, "period_month"], "left")


def join_rate(df: DataFrame, monthly_rate: DataFrame) -> DataFrame:
    """Attach the national monthly rate.

    ``monthly_rate`` has one row per calendar month, 12 a year whatever the volume below it; the
    planner sees its size and broadcasts it.
    """
    return df.join(monthly_rate, "period_month", "left")


def star_join(
    geography: DataFrame, market: DataFrame, crime: DataFrame, permits: DataFrame, key: str = "zip_code"
) -> DataFrame:
    """Every area with whatever of the three feeds covers it."""
    return geography.join(market, key, "left").join(crime, key, "left").join(permits, key, "left")


def against_all(
    series: DataFrame,
    zip_code,
    col: str,
    key: str = "zip_code",
    month: str = "period_month",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One area's monthly value next to the all-area median of the same month."""
    everyone = grouped_medians(series, [month], {f"all_{col}": col}, hot_rows=hot_rows)
    return (
        series.filter(F.col(key) == zip_code)
        .select(month, col)
        .join(everyone, month, "inner")
        .dropna(subset=[col, f"all_{col}"])
    )


def map_features(
    features: DataFrame,
    scores: DataFrame,
    feature_key: str = "zcta",
    key: str = "zip_code",
    rounding: Rounding = F.round,
) -> DataFrame:
    """Map shapes with what is known of their area, and neutral values where nothing is."""
    known = scores.select(
        F.col(key).alias(feature_key),
        "display_score",
        "region",
        "data_confidence",
        "median_sale_price",
        "median_household_income",
        F.lit(True).alias("_found"),
    )
    joined = features.join(known, feature_key, "left")
    score = F.when(F.col("_found"), F.col("display_score")).otherwise(F.lit(float(NEUTRAL_SCORE)))
    return joined.withColumns(
        {
            "fill_color": score_rgba(score),
            "display_score": rounding(score, 1),
            "region": F.coalesce("region", F.lit("—")),
            "data_confidence": F.coalesce("data_confidence", F.lit("—")),
            "median_sale_price": display_money(F.col("median_sale_price")),
            "median_household_income": display_money(F.col("median_household_income")),
        }
    ).drop("_found")


def with_supply(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "computed_months_of_supply", divide(F.col("median_inventory"), F.col("median_homes_sold"))
    )
