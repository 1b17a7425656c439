"""Intermediate models at area grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions.fixed_values import (
    ADMINISTRATIVE,
    DEFAULT_CATEGORY,
    INCIDENT_PATTERNS,
    SCORING_VINTAGE,
)
from areascore.functions.numbers import Rounding, ratio
from areascore.functions.text import classify
from areascore.functions.times import year_of
from areascore.operators.aggregates import HOT_ROWS, count_and_sum, count_by, monthly_medians
from areascore.operators.filters import drop_null, exclude_value, pin_vintage
from areascore.operators.joins import with_population, with_region

MARKET_MEDIANS = {
    "median_dom": "median_dom",
    "median_inventory": "inventory",
    "median_avg_sale_to_list": "avg_sale_to_list",
    "median_months_of_supply": "months_of_supply",
    "median_sale_price": "median_sale_price",
    "median_homes_sold": "homes_sold",
    "median_new_listings": "new_listings",
}


def zip_demographics(
    census: DataFrame, regions: DataFrame, year: int = SCORING_VINTAGE, rounding: Rounding = F.round
) -> DataFrame:
    """Census measures of one vintage with region and poverty rate."""
    return with_region(pin_vintage(census, year), regions).select(
        "zip_code",
        "region",
        "county_name",
        "county_fips",
        "median_household_income",
        "poverty_count",
        "total_population",
        ratio(F.col("poverty_count"), F.col("total_population"), rounding=rounding).alias("poverty_rate"),
        "vintage_year",
    )


def market_activity(market: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    return monthly_medians(market, "zip_code", "period_end", MARKET_MEDIANS, hot_rows=hot_rows)


def _criminal_counts(crime: DataFrame, keys: list[str]) -> DataFrame:
    """Incidents per ``keys`` without the administrative ones.

    The category is staged with the incident; where it isn't, it is found in the same map stage.
    Only the keys cross the shuffle, a handful of categories per area, year and task, never texts.
    """
    if "crime_category" not in crime.columns:
        crime = crime.withColumn("crime_category", classify(F.col("incident_type"), INCIDENT_PATTERNS, DEFAULT_CATEGORY))
    criminal = exclude_value(crime, "crime_category", ADMINISTRATIVE)
    return count_by(criminal.withColumn("incident_year", year_of(F.col("incident_occurred"))), keys, "incident_count")


def crime_index(crime: DataFrame, demographics: DataFrame, rounding: Rounding = F.round) -> DataFrame:
    """Yearly incidents per area and per 1,000 residents. Counted before the join."""
    counts = _criminal_counts(crime, ["zip_code", "incident_year"])
    return with_population(counts, demographics, rounding=rounding)


def crime_by_category(crime: DataFrame, demographics: DataFrame, rounding: Rounding = F.round) -> DataFrame:
    counts = _criminal_counts(crime, ["zip_code", "incident_year", "crime_category"])
    return with_population(counts, demographics, rounding=rounding)


def permit_activity(permits: DataFrame, money_scale: int | None = None) -> DataFrame:
    dated = drop_null(permits, ["date_issued"]).withColumn("permit_year", year_of(F.col("date_issued")))
    return count_and_sum(
        dated, ["zip_code", "permit_year"], "construction_cost", "permit_count",
        "total_construction_cost", money_scale,
    )
