"""All models from raw tables to marts, and the run that publishes and checks them."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from areascore.functions.fixed_values import FRESHNESS_LIMITS
from areascore.operators.aggregates import summarise_checks
from areascore.plans import intermediate, marts, staging
from areascore.plans.contracts import check_models, check_sources
from areascore.sources.tables import append_audit, publish

LAYER_OF = {
    **{name: "staging" for name in (
        "stg_home_values", "stg_market", "stg_census_zip", "stg_census_county", "stg_crime",
        "stg_rates", "stg_permits")},
    **{name: "intermediate" for name in (
        "zip_demographics", "market_activity", "crime_index", "crime_by_category", "permit_activity")},
    **{name: "marts" for name in ("monthly_fact", "geography", "opportunity_score")},
}


def run_models(
    raw: Mapping[str, DataFrame], valid: DataFrame, regions: DataFrame, materialise: bool = False
) -> dict[str, DataFrame]:
    """Every model by name.

    Lazy by default. With ``materialise`` staging becomes views and the later layers become
    tables, so each model is computed once and the next one reads its table.
    """
    out: dict[str, DataFrame] = {}

    def add(name: str, df: DataFrame) -> DataFrame:
        out[name] = publish(df, LAYER_OF[name], name) if materialise else df
        return out[name]

    values = add("stg_home_values", staging.stg_home_values(raw["home_values"], valid))
    market = add("stg_market", staging.stg_market(raw["market"], valid))
    census = add("stg_census_zip", staging.stg_census_zip(raw["census_zip"], valid))
    add("stg_census_county", staging.stg_census_county(raw["census_county"]))
    crime = add("stg_crime", staging.stg_crime(raw["crime"], valid))
    rates = add("stg_rates", staging.stg_rates(raw["rates"]))
    permits = add("stg_permits", staging.stg_permits(raw["permits"], valid))

    people = add("zip_demographics", intermediate.zip_demographics(census, regions))
    activity = add("market_activity", intermediate.market_activity(market))
    index = add("crime_index", intermediate.crime_index(crime, people))
    add("crime_by_category", intermediate.crime_by_category(crime, people))
    issued = add("permit_activity", intermediate.permit_activity(permits))

    monthly = add("monthly_fact", marts.monthly_fact(activity, values, rates))
    geo = add("geography", marts.geography(people))
    add("opportunity_score", marts.opportunity_score(geo, monthly, index, issued))
    return out


def run_and_check(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    valid: DataFrame,
    regions: DataFrame,
    audit_path: str,
    now: datetime,
    job_name: str = "daily",
) -> dict:
    """Publish all models, run the declared checks and source freshness, write one audit row."""
    models = run_models(raw, valid, regions, materialise=True)
    summary = summarise_checks(check_models(models)).head()
    ages = {row["source"]: row["status"] for row in check_sources(raw, now).collect()}
    order = ["pass", "warn", "error"]
    census = max((ages["census_zip"], ages["census_county"]), key=order.index)
    status = "success" if summary["tests_run"] == summary["tests_passed"] else "failure"
    run_id = append_audit(
        spark, audit_path, job_name, status, now=now,
        tests_run=summary["tests_run"], tests_passed=summary["tests_passed"],
        market=ages["market"], home_values=ages["home_values"], crime=ages["crime"], census=census,
        notes=", ".join(f"{name}={ages[name]}" for name in FRESHNESS_LIMITS),
    )
    return {"run_id": run_id, "status": status, "models": models, **summary.asDict()}
