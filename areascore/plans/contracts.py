"""Declared checks of the models: column tests, grains, ranges and null budgets."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions.fixed_values import FRESHNESS_LIMITS, RATE_SERIES, VALUE_METRICS
from areascore.operators.checks import check_freshness, run_checks
from areascore.operators.reshape import union_all

CATEGORIES = ["Violent", "Property", "Drug", "Administrative", "Other"]

CONTRACTS: dict[str, dict] = {
    "stg_home_values": {
        "not_null": ["zip_code", "period_month", "metric_type", "value"],
        "accepted": {"metric_type": VALUE_METRICS},
    },
    "stg_market": {"not_null": ["zip_code", "period_end"]},
    "stg_census_zip": {
        "not_null": ["zip_code", "vintage_year"], "grains": [["zip_code", "vintage_year"]],
    },
    "stg_census_county": {
        "not_null": ["county_fips", "vintage_year"], "grains": [["county_fips", "vintage_year"]],
    },
    "stg_crime": {
        "not_null": ["zip_code", "incident_occurred", "crime_category"],
        "accepted": {"crime_category": CATEGORIES},
    },
    "stg_rates": {
        "not_null": ["observation_date", "rate", "series_id"],
        "unique": ["observation_date"],
        "accepted": {"series_id": [RATE_SERIES]},
    },
    "stg_permits": {"not_null": ["permit_number", "date_issued", "zip_code"], "unique": ["permit_number"]},
    "zip_demographics": {
        "not_null": ["zip_code", "county_fips", "region"], "unique": ["zip_code"],
        "null_budgets": {"poverty_rate": 5},
    },
    "market_activity": {"not_null": ["zip_code", "period_month"], "grains": [["zip_code", "period_month"]]},
    "crime_index": {
        "not_null": ["zip_code", "incident_year"], "grains": [["zip_code", "incident_year"]],
        "null_budgets": {"incidents_per_1k": 10},
    },
    "crime_by_category": {
        "not_null": ["zip_code", "incident_year", "crime_category", "incident_count"],
        "accepted": {"crime_category": [c for c in CATEGORIES if c != "Administrative"]},
    },
    "permit_activity": {
        "not_null": ["zip_code", "permit_year", "permit_count"], "grains": [["zip_code", "permit_year"]],
    },
    "monthly_fact": {"not_null": ["zip_code", "period_month", "avg_mortgage_rate"]},
    "geography": {"not_null": ["zip_code", "county_fips", "region"], "unique": ["zip_code"]},
    "opportunity_score": {
        "not_null": ["zip_code", "opportunity_score", "permit_score", "data_confidence"],
        "unique": ["zip_code"],
        "accepted": {"data_confidence": ["High", "Partial", "Low"]},
        "ranges": {"opportunity_score": (0, 100)},
    },
}


def check_models(models: Mapping[str, DataFrame]) -> DataFrame:
    """Results of the declared checks of ``models`` as (check, violations, status) rows.

    A check may read its model more than once; hand in published tables or settled frames.
    """
    return union_all([run_checks(name, df, **CONTRACTS[name]) for name, df in models.items()])


def check_sources(raw: Mapping[str, DataFrame], now: datetime | str) -> DataFrame:
    """Freshness of every raw table as (source, latest, age_days, status) rows."""
    return union_all(
        [
            check_freshness(raw[name], "ingested_at", warn, error, now).withColumn("source", F.lit(name))
            for name, (warn, error) in FRESHNESS_LIMITS.items()
        ]
    )
