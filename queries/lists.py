"""Queries for seed lists, the census staging models and ordered output."""

from __future__ import annotations

from pyspark.sql import functions as F

from areascore.functions.fixed_values import COUNTIES, SPLIT_COUNTY, SPLIT_DEFAULT, SPLIT_REGIONS
from areascore.operators.ordering import ordered, with_places
from areascore.plans import staging
from areascore.plans.seeds import areas_per_county, build_seeds
from queries import model_sql as m
from queries import standins as s
from queries.registry import query

_CODES = sorted(COUNTIES)
_LISTED = ", ".join(f"('{code}', '{name}', '{region}')" for code, (name, region) in COUNTIES.items())
_SPLIT = ", ".join(f"('{zip_code}', '{region}')" for region, codes in SPLIT_REGIONS.items() for zip_code in codes)

# Parts stand for areas, spread over the area codes; nations stand for counties, the last one for none that counts.
_SEEDS = f"""
counties(county_fips, county_name, region) AS (VALUES {_LISTED}),
split(zip_code, region) AS (VALUES {_SPLIT}),
shared AS (
  SELECT CAST(37000 + l_partkey % 300 AS VARCHAR) AS zip_code,
         (['{"', '".join([*_CODES, "01001"])}'])[1 + s_nationkey % {len(_CODES) + 1}] AS county_fips,
         CAST(l_quantity * 10 + l_linenumber AS BIGINT) AS overlap, l_orderkey
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
best AS (
  SELECT zip_code, arg_max(county_fips, (overlap, -CAST(county_fips AS INT))) AS county_fips
  FROM shared WHERE county_fips IN (SELECT county_fips FROM counties) GROUP BY 1),
placed AS (
  SELECT b.zip_code, b.county_fips, county_name,
         CASE WHEN b.county_fips <> '{SPLIT_COUNTY}' THEN c.region ELSE coalesce(split.region, '{SPLIT_DEFAULT}') END AS region
  FROM best b JOIN counties c USING (county_fips) LEFT JOIN split ON split.zip_code = b.zip_code)"""


def _relationship(spark, sf):
    lineitem, supplier = s.load(spark, sf, "lineitem"), s.load(spark, sf, "supplier")
    county = F.element_at(F.array(*map(F.lit, [*_CODES, "01001"])), (F.col("s_nationkey") % (len(_CODES) + 1) + 1).cast("int"))
    return lineitem.join(supplier, lineitem["l_suppkey"] == supplier["s_suppkey"]).select(
        (F.lit(37000) + F.col("l_partkey") % 300).cast("string").alias("GEOID_ZCTA5_20"),
        county.alias("GEOID_COUNTY_20"),
        (F.col("l_quantity") * 10 + F.col("l_linenumber")).cast("long").cast("string").alias("AREALAND_PART"),
    )


@query(f"{m.with_(_SEEDS)} SELECT * FROM placed")
def seed_regions(spark, sf):
    return build_seeds(_relationship(spark, sf))[1]


@query(f"{m.with_(_SEEDS)} SELECT county_name, count(*) AS areas FROM placed GROUP BY 1")
def seed_areas_per_county(spark, sf):
    return areas_per_county(build_seeds(_relationship(spark, sf))[1])


@query(
    f"""{m.with_(s.REGIONS, s.CENSUS)} SELECT zip_code, median_household_income, poverty_count, total_population, vintage_year
    FROM census WHERE zip_code IN (SELECT zip_code FROM regions)"""
)
def staged_census_areas(spark, sf):
    return staging.stg_census_zip(s.census(spark, sf).withColumnRenamed("zip_code", "zcta"), s.regions(spark, sf))


@query(
    f"""{m.with_(s.REGIONS, s.CENSUS)} SELECT county_fips, county_name, median_household_income, poverty_count,
      total_population, vintage_year FROM census JOIN regions USING (zip_code)"""
)
def staged_census_counties(spark, sf):
    return staging.stg_census_county(s.census(spark, sf).join(s.regions(spark, sf), "zip_code"))


_SOUTH = """valid AS (SELECT zip_code FROM regions WHERE CAST(county_fips AS INT) < 3)"""


def _some_regions(spark, sf):
    return s.regions(spark, sf).filter(F.col("county_fips").cast("int") < 3)


@query(
    f"""{m.with_(s.REGIONS, s.HOME_VALUES, _SOUTH)} SELECT zip_code, period_month, value, metric_type FROM home_values
    WHERE value IS NOT NULL AND value > 1000 AND zip_code IN (SELECT zip_code FROM valid)"""
)
def staged_home_values(spark, sf):
    """Values up to 1,000 stand for missing ones."""
    raw = s.home_values(spark, sf).withColumn("value", F.when(F.col("value") > 1000, F.col("value")))
    return staging.stg_home_values(raw, _some_regions(spark, sf))


@query(
    f"""{m.with_(s.REGIONS, s.market_sql(), _SOUTH)} SELECT zip_code, period_end, {", ".join(staging.MARKET_MEASURES)} FROM market
    WHERE zip_code IN (SELECT zip_code FROM valid)"""
)
def staged_market(spark, sf):
    return staging.stg_market(s.market(spark, sf), _some_regions(spark, sf))


@query(
    """SELECT s_suppkey, row_number() OVER (ORDER BY s_nationkey DESC, s_acctbal, s_suppkey) AS place FROM supplier"""
)
def ordered_rows(spark, sf):
    """The place that each row comes out at: partitions in order, rows in order inside them."""
    out = ordered(s.load(spark, sf, "supplier"), [F.col("s_nationkey").desc(), "s_acctbal", "s_suppkey"])
    return with_places(out.select("s_suppkey"))
