"""Seed lists from the area-to-county relationship file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions.fixed_values import COUNTIES, SPLIT_COUNTY, SPLIT_DEFAULT, SPLIT_REGIONS
from areascore.functions.text import blank_as_zero, clean_code, county_name_of, region_of
from areascore.operators.aggregates import count_by
from areascore.operators.filters import keep_codes
from areascore.operators.windows import argmax_by


def build_seeds(relationship: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid areas, area regions). An area belongs to the county it overlaps most; equal
    overlaps go to the lower county code."""
    overlaps = relationship.select(
        clean_code(F.col("GEOID_ZCTA5_20")).alias("zip_code"),
        clean_code(F.col("GEOID_COUNTY_20")).alias("county_fips"),
        blank_as_zero(F.coalesce("AREALAND_PART", F.lit(""))).alias("overlap"),
    )
    best = argmax_by(keep_codes(overlaps, "county_fips", list(COUNTIES)), "zip_code", "overlap", ["county_fips"])
    county = F.col("county_fips")
    regions = best.select(
        "zip_code",
        region_of(F.col("zip_code"), county, COUNTIES, SPLIT_COUNTY, SPLIT_REGIONS, SPLIT_DEFAULT).alias("region"),
        county_name_of(county, COUNTIES).alias("county_name"),
        "county_fips",
    ).orderBy("zip_code")
    return regions.select("zip_code"), regions


def areas_per_county(regions: DataFrame) -> DataFrame:
    return count_by(regions, ["county_name"], "areas").orderBy("county_name")
