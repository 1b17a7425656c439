"""Mart models: monthly fact, geography, opportunity score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions.fixed_values import SIGNALS
from areascore.functions.numbers import Rounding, exact_mean
from areascore.functions.scores import composite, confidence, minmax_score
from areascore.operators.aggregates import monthly_mean
from areascore.operators.joins import join_rate, join_valuation, star_join, with_supply
from areascore.operators.reshape import pivot_metrics
from areascore.operators.windows import latest_month_rows, latest_per, with_global_stats
from areascore.plans import intermediate

# Score column -> (signal column, direction, imputation, zero-floored minimum).
SIGNAL_RULES = {
    "affordability_score": ("median_sale_price", "inverted", None, False),
    "market_speed_score": ("median_dom", "inverted", None, False),
    "activity_score": ("median_homes_sold", "direct", None, False),
    "income_score": ("median_household_income", "direct", None, False),
    "poverty_score": ("poverty_rate", "inverted", None, False),
    "safety_score": ("incidents_per_1k", "inverted", "mean", True),
    "permit_score": ("permit_count", "direct", "mean", False),
}
# Rates are rounded to two decimals, so their mean can be taken exactly.
EXACT_MEANS = {"incidents_per_1k": exact_mean}

SCORE_COLUMNS = [
    "zip_code", "region", "county_name", "county_fips", "market_as_of", "crime_as_of",
    "median_sale_price", "median_dom", "median_homes_sold", "median_household_income",
    "poverty_rate", "incidents_per_1k", "permit_year", "permit_count", "total_construction_cost",
]


def monthly_fact(market: DataFrame, values: DataFrame, rates: DataFrame, mean=F.avg, rounding: Rounding = F.round) -> DataFrame:
    """Market medians with home values and the national rate, per area and month."""
    rate = monthly_mean(rates, "observation_date", "rate", 2, "avg_mortgage_rate", mean, rounding)
    return join_rate(join_valuation(with_supply(market), pivot_metrics(values)), rate)


def geography(demographics: DataFrame) -> DataFrame:
    return demographics.select(
        "zip_code", "region", "county_name", "county_fips", "median_household_income",
        "poverty_count", "total_population", "poverty_rate", "vintage_year",
    )


def combine_signals(geo: DataFrame, monthly: DataFrame, crime: DataFrame, permits: DataFrame) -> DataFrame:
    """One row per area with the latest of each feed."""
    market = latest_per(monthly, ["zip_code"], "period_month").select(
        "zip_code", F.col("period_month").alias("market_as_of"), "median_sale_price", "median_dom",
        "median_homes_sold",
    )
    incidents = latest_per(crime, ["zip_code"], "incident_year").select(
        "zip_code", F.col("incident_year").alias("crime_as_of"), "incidents_per_1k"
    )
    issued = latest_per(permits, ["zip_code"], "permit_year").select(
        "zip_code", "permit_year", "permit_count", "total_construction_cost"
    )
    return star_join(geo, market, incidents, issued).select(*SCORE_COLUMNS)


def latest_signals(
    demographics: DataFrame, market: DataFrame, crime: DataFrame, permits: DataFrame,
    rounding: Rounding = F.round, money_scale: int | None = None,
) -> DataFrame:
    """``combine_signals`` from staged feeds. Only the latest month of each area's market rows is
    aggregated, since the score reads no other."""
    latest = latest_month_rows(market, "zip_code", "period_end")
    return combine_signals(
        geography(demographics),
        intermediate.market_activity(latest),
        intermediate.crime_index(crime, demographics, rounding),
        intermediate.permit_activity(permits, money_scale),
    )


def score_areas(combined: DataFrame, rounding: Rounding = F.round) -> DataFrame:
    """Seven scores, the composite and the completeness label.

    ``combined`` is read twice, once for the whole-table statistics; hand in a written table or
    a settled frame when it is the end of a long plan.
    """
    signals = [rule[0] for rule in SIGNAL_RULES.values()]
    with_stats = with_global_stats(combined, signals, EXACT_MEANS)
    scored = with_stats.withColumns(
        {
            score: minmax_score(col, F.col("stats"), direction, impute, floor0, rounding=rounding)
            for score, (col, direction, impute, floor0) in SIGNAL_RULES.items()
        }
    )
    return scored.select(
        *SCORE_COLUMNS,
        *SIGNAL_RULES,
        composite(list(SIGNALS.values()), rounding=rounding).alias("opportunity_score"),
        confidence(F.col("median_sale_price"), F.col("incidents_per_1k")).alias("data_confidence"),
    )


def opportunity_score(geo: DataFrame, monthly: DataFrame, crime: DataFrame, permits: DataFrame, rounding: Rounding = F.round) -> DataFrame:
    return score_areas(combine_signals(geo, monthly, crime, permits), rounding)
