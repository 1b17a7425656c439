"""Staging models: area filter, types, classification, deduplication. ``ingested_at`` is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions.fixed_values import DEFAULT_CATEGORY, INCIDENT_PATTERNS
from areascore.functions.text import classify
from areascore.operators.joins import restrict_to
from areascore.operators.windows import dedup, latest_per

MARKET_MEASURES = [
    "median_dom", "inventory", "avg_sale_to_list", "months_of_supply", "median_sale_price",
    "homes_sold", "new_listings",
]
CENSUS_MEASURES = ["median_household_income", "poverty_count", "total_population"]


def stg_home_values(raw: DataFrame, valid: DataFrame) -> DataFrame:
    return restrict_to(raw.filter(F.col("value").isNotNull()), valid, "zip_code").select(
        "zip_code", F.col("period_month").cast("date").alias("period_month"), "value", "metric_type"
    )


def stg_market(raw: DataFrame, valid: DataFrame) -> DataFrame:
    return restrict_to(raw, valid, "zip_code").select(
        "zip_code", F.col("period_end").cast("date").alias("period_end"), *MARKET_MEASURES
    )


def stg_census_zip(raw: DataFrame, valid: DataFrame) -> DataFrame:
    areas = raw.withColumnRenamed("zcta", "zip_code")
    return restrict_to(areas, valid, "zip_code").select("zip_code", *CENSUS_MEASURES, "vintage_year")


def stg_census_county(raw: DataFrame) -> DataFrame:
    return raw.select("county_fips", "county_name", *CENSUS_MEASURES, "vintage_year")


def stg_crime(raw: DataFrame, valid: DataFrame) -> DataFrame:
    """Incidents of the valid areas with their category; null text is Other."""
    return restrict_to(raw, valid, "zip_code").select(
        "incident_occurred",
        "incident_type",
        "zip_code",
        classify(F.col("incident_type"), INCIDENT_PATTERNS, DEFAULT_CATEGORY).alias("crime_category"),
    )


def stg_rates(raw: DataFrame) -> DataFrame:
    """One row per observation date: the one loaded last, then the lowest rate."""
    tie = [F.col("ingested_at").desc_nulls_last(), F.col("rate").asc_nulls_last()]
    return dedup(raw, ["observation_date"], tie).select("observation_date", "rate", "series_id")


def stg_permits(raw: DataFrame, valid: DataFrame) -> DataFrame:
    """Newest record per permit among those in valid areas: the area filter comes first, so a
    permit whose newest record lies elsewhere keeps its older one."""
    tie = [
        F.col("ingested_at").desc_nulls_last(), "zip_code", "permit_type",
        F.col("construction_cost").desc_nulls_last(),
    ]
    return latest_per(restrict_to(raw, valid, "zip_code"), ["permit_number"], "date_issued", tie).select(
        "permit_number", "permit_type", "date_issued", "zip_code", "construction_cost"
    )
