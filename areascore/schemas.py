"""Column contracts of raw tables, seeds, state and audit."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, NUMBER, DAY, MOMENT = StringType(), DoubleType(), DateType(), TimestampNTZType()


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


RAW_TABLES: dict[str, StructType] = {
    "home_values": _struct(
        zip_code=TEXT, state=TEXT, metro=TEXT, county_name=TEXT, period_month=DAY,
        value=NUMBER, metric_type=TEXT, ingested_at=MOMENT,
    ),
    "market": _struct(
        zip_code=TEXT, state_code=TEXT, period_end=DAY, median_dom=NUMBER, inventory=NUMBER,
        avg_sale_to_list=NUMBER, months_of_supply=NUMBER, median_sale_price=NUMBER,
        homes_sold=NUMBER, new_listings=NUMBER, ingested_at=MOMENT,
    ),
    "census_zip": _struct(
        zcta=TEXT, state_fips=TEXT, median_household_income=NUMBER, poverty_count=NUMBER,
        total_population=NUMBER, vintage_year=IntegerType(), ingested_at=MOMENT,
    ),
    "census_county": _struct(
        county_fips=TEXT, county_name=TEXT, state_fips=TEXT, median_household_income=NUMBER,
        poverty_count=NUMBER, total_population=NUMBER, vintage_year=IntegerType(), ingested_at=MOMENT,
    ),
    "crime": _struct(incident_occurred=MOMENT, incident_type=TEXT, zip_code=TEXT, ingested_at=MOMENT),
    "permits": _struct(
        permit_number=TEXT, permit_type=TEXT, date_issued=MOMENT, zip_code=TEXT,
        construction_cost=NUMBER, ingested_at=MOMENT,
    ),
    "rates": _struct(observation_date=DAY, rate=NUMBER, series_id=TEXT, ingested_at=MOMENT),
    "property": _struct(
        apn=TEXT, prop_zip=TEXT, lu_code=TEXT, lu_desc=TEXT, sale_price=NUMBER, own_date=DAY,
        valid_sale=TEXT, totl_appr=NUMBER, totl_assd=NUMBER, ingested_at=MOMENT,
    ),
}

STATE = _struct(
    source_name=TEXT, watermark_date=TEXT, last_etag=TEXT, updated_at=MOMENT, version=LongType()
)
AUDIT = _struct(
    run_id=TEXT, run_timestamp=MOMENT, job_name=TEXT, status=TEXT, tests_run=IntegerType(),
    tests_passed=IntegerType(), freshness_market=TEXT, freshness_home_values=TEXT,
    freshness_property=TEXT, freshness_crime=TEXT, freshness_census=TEXT, notes=TEXT,
)

SEED_VALID = _struct(zip_code=TEXT)
SEED_REGIONS = _struct(zip_code=TEXT, region=TEXT, county_name=TEXT, county_fips=TEXT)
SEED_COVERAGE = _struct(agency_name=TEXT, county=TEXT, zip_code=TEXT, coverage_type=TEXT, notes=TEXT)

# Attribute structs of the paged feature feeds. Times are epoch milliseconds that may arrive as
# whole or decimal numbers; a double holds both exactly.
CRIME_ATTRIBUTES = _struct(Incident_Occurred=NUMBER, Offense_Description=TEXT, ZIP_Code=TEXT)
PERMIT_ATTRIBUTES = _struct(
    Permit__=TEXT, Permit_Type_Description=TEXT, Date_Issued=NUMBER, ZIP=TEXT, Const_Cost=TEXT
)
PROPERTY_ATTRIBUTES = _struct(
    APN=TEXT, PropZip=TEXT, LUCode=TEXT, LUDesc=TEXT, SalePrice=NUMBER, OwnDate=NUMBER,
    ValidSale=TEXT, TotlAppr=NUMBER, TotlAssd=NUMBER,
)


def feature_page(attributes: StructType) -> StructType:
    """A page of features; ``error`` is present when the service refused the request."""
    return _struct(features=ArrayType(_struct(attributes=attributes)), error=TEXT)


OBSERVATIONS = _struct(observations=ArrayType(_struct(date=TEXT, value=TEXT)))
