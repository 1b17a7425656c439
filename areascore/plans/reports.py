"""Report queries, one function per page. Each returns named DataFrames; hand in published
tables, since a page reads its marts several times."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions.display import badge, status_icon
from areascore.functions.fixed_values import SIGNALS
from areascore.functions.numbers import Rounding
from areascore.functions.scores import reweighted
from areascore.operators.aggregates import (
    all_area_monthly,
    extreme_area,
    kpis,
    latest_nonnull,
    median_by,
)
from areascore.operators.filters import one_area, positive_only
from areascore.operators.joins import against_all, map_features
from areascore.operators.ordering import distinct_sorted, ordered, top_n
from areascore.operators.reshape import unpivot_freshness

EQUAL_WEIGHTS = {signal: 5 for signal in SIGNALS}
BALANCED_SUPPLY_MONTHS = 6
RUNS_SHOWN = 30


def reweight(
    scores: DataFrame,
    weights: Mapping[str, float] = EQUAL_WEIGHTS,
    default: float | None = None,
    rounding: Rounding = F.round,
) -> DataFrame:
    return scores.withColumn("display_score", reweighted(weights, default=default, rounding=rounding))


def map_page(
    scores: DataFrame, features: DataFrame | None = None, weights: Mapping[str, float] = EQUAL_WEIGHTS, rounding: Rounding = F.round
) -> dict[str, DataFrame]:
    shown = reweight(scores, weights, rounding=rounding)
    by_score = [F.col("display_score").desc_nulls_last(), "zip_code"]
    page = {
        "table": ordered(shown, by_score).select(
            "zip_code", "region", "county_name", "display_score",
            badge(F.col("data_confidence")).alias("data_confidence"),
            "median_sale_price", "median_household_income", "incidents_per_1k", "permit_count",
        ),
        "kpis": kpis(
            shown,
            {
                "top_zip": extreme_area(shown, "display_score", "max", missing=None),
                "top_score": F.max("display_score"),
                "average_score": F.avg("display_score"),
                "lowest_score": F.min("display_score"),
            },
        ),
        "top": top_n(shown, "display_score", 1).select("zip_code", "display_score"),
    }
    if features is not None:
        page["features"] = map_features(features, shown)
    return page


def area_list(monthly: DataFrame) -> DataFrame:
    return distinct_sorted(monthly, "zip_code")


def affordability_page(monthly: DataFrame, scores: DataFrame, zip_code: str) -> dict[str, DataFrame]:
    trend = all_area_monthly(
        monthly,
        {"zhvi": "zhvi", "median_sale_price": "median_sale_price"},
        {"avg_mortgage_rate": "avg_mortgage_rate"},
    )
    return {
        "trend": ordered(trend, ["period_month"]),
        "value_trend": ordered(trend.dropna(subset=["zhvi"]), ["period_month"]),
        "rate_trend": ordered(trend.dropna(subset=["avg_mortgage_rate"]), ["period_month"]),
        "latest": latest_nonnull(trend, None, "period_month", ["zhvi", "avg_mortgage_rate"]),
        "kpis": kpis(
            scores,
            {
                "median_sale_price": ("median", "median_sale_price"),
                "median_household_income": ("median", "median_household_income"),
            },
        ),
        "region_prices": median_by(scores, "region", "median_sale_price").orderBy(
            F.col("median_sale_price").desc(), "region"
        ),
        "area": ordered(against_all(monthly, zip_code, "zhvi"), ["period_month"]),
    }


def inventory_page(monthly: DataFrame, zip_code: str) -> dict[str, DataFrame]:
    latest = latest_nonnull(
        monthly, "zip_code", "period_month",
        ["median_inventory", "computed_months_of_supply", "median_new_listings"],
    )
    trend = all_area_monthly(
        monthly,
        {
            "median_inventory": "median_inventory",
            "months_of_supply": "computed_months_of_supply",
            "new_listings": "median_new_listings",
        },
    )
    return {
        "kpis": kpis(
            latest,
            {
                "inventory": ("median", "median_inventory"),
                "months_of_supply": ("median", "computed_months_of_supply"),
                "new_listings": ("median", "median_new_listings"),
            },
        ),
        "trend": ordered(trend, ["period_month"]),
        "supply_trend": ordered(trend.dropna(subset=["months_of_supply"]), ["period_month"]),
        "area_inventory": ordered(against_all(monthly, zip_code, "median_inventory"), ["period_month"]),
        "area_supply": ordered(
            against_all(monthly, zip_code, "computed_months_of_supply"), ["period_month"]
        ),
    }


def crime_rates(
    index: DataFrame, by_category: DataFrame, regions: DataFrame, category: str = "All"
) -> DataFrame:
    """Yearly rates per area for one category, or for all criminal incidents."""
    rates = index if category == "All" else by_category.filter(F.col("crime_category") == category)
    return rates.join(regions.select("zip_code", "region"), "zip_code").select(
        "zip_code", "region", "incident_year", "incident_count", "incidents_per_1k"
    )


def crime_page(
    scores: DataFrame, index: DataFrame, by_category: DataFrame, category: str = "All"
) -> dict[str, DataFrame]:
    known = scores.dropna(subset=["incidents_per_1k"])
    rates = crime_rates(index, by_category, scores, category)
    return {
        "kpis": kpis(
            known,
            {
                "median_rate": ("median", "incidents_per_1k"),
                "safest_zip": extreme_area(known, "incidents_per_1k", "min"),
                "highest_zip": extreme_area(known, "incidents_per_1k", "max"),
            },
        ),
        "areas": top_n(known, "incidents_per_1k", 30).select("zip_code", "region", "incidents_per_1k"),
        "trend": median_by(rates, "incident_year", "incidents_per_1k", "all_median").orderBy("incident_year"),
        "regions": median_by(known, "region", "incidents_per_1k").orderBy(
            F.col("incidents_per_1k").desc(), "region"
        ),
        "category_rates": ordered(rates, ["zip_code", "incident_year"]),
    }


def momentum_page(monthly: DataFrame, zip_code: str) -> dict[str, DataFrame]:
    cols = ["median_dom", "median_avg_sale_to_list", "median_sale_price"]
    latest = latest_nonnull(monthly, "zip_code", "period_month", cols)
    trend = all_area_monthly(monthly, {c: c for c in cols[:2]})
    return {
        "kpis": kpis(latest, {c: ("median", c) for c in cols}),
        "trend": ordered(trend, ["period_month"]),
        "area": ordered(against_all(monthly, zip_code, "median_dom"), ["period_month"]),
    }


def transactions_page(monthly: DataFrame, scores: DataFrame, zip_code: str) -> dict[str, DataFrame]:
    sold = one_area(monthly, zip_code).select("period_month", "median_homes_sold")
    return {
        "kpis": kpis(
            scores,
            {
                "homes_sold": ("median", "median_homes_sold"),
                "permits": ("median", "permit_count"),
                "top_permit_zip": extreme_area(scores, "permit_count", "max"),
            },
        ),
        "trend": ordered(
            all_area_monthly(monthly, {"median_homes_sold": "median_homes_sold"}), ["period_month"]
        ),
        "area": ordered(sold.dropna(), ["period_month"]),
        "permits": top_n(positive_only(scores, "permit_count"), "permit_count", 20).select(
            "zip_code", "region", "permit_count"
        ),
    }


def audit_display(df: DataFrame) -> DataFrame:
    """Run time to the minute, upper-case status, passed over run."""
    tests = F.concat(F.col("tests_passed").cast("string"), F.lit("/"), F.col("tests_run").cast("string"))
    return df.select(
        F.substring(F.col("run_timestamp").cast("string"), 1, 16).alias("last_run"),
        "job_name",
        F.upper("status").alias("status"),
        F.when(F.col("tests_run").isNull(), "N/A").otherwise(tests).alias("tests"),
    )


def health_page(audit: DataFrame) -> dict[str, DataFrame]:
    recent = top_n(audit, "run_timestamp", RUNS_SHOWN, ["run_id"])
    last = top_n(audit, "run_timestamp", 1, ["run_id"])
    return {
        "runs": recent,
        "last": audit_display(last),
        "freshness": unpivot_freshness(last).withColumn("shown", status_icon(F.col("status"))),
    }
