"""The given tables in the shape of the domain tables, on both engines.

Areas are nations. Three feeds cover different areas: the market feed files areas above 23
under 23, the permit feed files areas above 21 under 21, and the incident feed knows areas
0 to 19. Every row is used; the areas left without a feed exercise imputation and labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKET_TOP, PERMIT_TOP, CRIME_AREAS = 23, 21, 20

# Event type -> offence text, so that every category occurs.
OFFENCES = {
    "click": "POLICE INQUIRY",
    "error": "Simple Assault",
    "purchase": "SHOPLIFTING",
    "signup": "Trespass of real property",
    "view": "Drug paraphernalia",
}
METRIC_OF_STATUS = {"F": "ZHVI", "O": "ZORI", "P": "ZHVF"}


_SCHEMAS: dict = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def chosen(col: str, table: dict[str, str]):
    out = None
    for key, value in table.items():
        out = F.when(F.col(col) == key, value) if out is None else out.when(F.col(col) == key, value)
    return out


def regions(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = load(spark, sf, "nation"), load(spark, sf, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("zip_code"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("county_name"),
        F.col("n_regionkey").cast("string").alias("county_fips"),
    )


def market(spark: SparkSession, sf: str, top: int = 24) -> DataFrame:
    lineitem, supplier = load(spark, sf, "lineitem"), load(spark, sf, "supplier")
    return lineitem.join(supplier, lineitem["l_suppkey"] == supplier["s_suppkey"]).select(
        F.least(F.col("s_nationkey"), F.lit(top)).alias("zip_code"),
        F.col("l_shipdate").cast("date").alias("period_end"),
        F.col("l_quantity").alias("median_dom"),
        (F.col("l_quantity") * F.col("l_linenumber")).alias("inventory"),
        (1 - F.col("l_discount")).alias("avg_sale_to_list"),
        F.lit(None).cast("double").alias("months_of_supply"),
        F.col("l_extendedprice").alias("median_sale_price"),
        F.col("l_linenumber").cast("double").alias("homes_sold"),
        (F.col("l_tax") * 100).alias("new_listings"),
    )


def census(spark: SparkSession, sf: str) -> DataFrame:
    """One vintage: residents, residents in debt, and mean balance per area."""
    balance = F.col("c_acctbal").cast("decimal(18,2)")
    return load(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("zip_code")).agg(
        (F.sum(balance).cast("double") / F.count(F.lit(1))).alias("median_household_income"),
        F.count_if(F.col("c_acctbal") < 0).cast("double").alias("poverty_count"),
        F.count(F.lit(1)).cast("double").alias("total_population"),
        F.lit(2023).alias("vintage_year"),
    )


def crime(spark: SparkSession, sf: str, areas: int = 25) -> DataFrame:
    return load(spark, sf, "events").select(
        (F.col("user_id") % areas).cast("int").alias("zip_code"),
        F.col("ts").cast("timestamp_ntz").alias("incident_occurred"),
        chosen("event_type", OFFENCES).alias("incident_type"),
    )


def _orders_by_area(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = load(spark, sf, "orders"), load(spark, sf, "customer")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"])


def home_values(spark: SparkSession, sf: str) -> DataFrame:
    return _orders_by_area(spark, sf).select(
        F.col("c_nationkey").alias("zip_code"),
        F.col("o_orderdate").cast("date").alias("period_month"),
        F.col("o_totalprice").alias("value"),
        chosen("o_orderstatus", METRIC_OF_STATUS).alias("metric_type"),
    )


def rates(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("observation_date"),
        F.col("o_totalprice").alias("rate"),
        F.lit("MORTGAGE30US").alias("series_id"),
        F.lit(None).cast("timestamp_ntz").alias("ingested_at"),
    )


def permits(spark: SparkSession, sf: str, top: int = 24) -> DataFrame:
    return _orders_by_area(spark, sf).select(
        F.col("o_custkey").alias("permit_number"),
        F.col("o_orderpriority").alias("permit_type"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("date_issued"),
        F.least(F.col("c_nationkey"), F.lit(top)).alias("zip_code"),
        F.col("o_totalprice").alias("construction_cost"),
        F.lit(None).cast("timestamp_ntz").alias("ingested_at"),
    )


# -- the same on the SQL side -----------------------------------------------------------------

REGIONS = """
regions AS (
  SELECT n_nationkey AS zip_code, r_name AS region, n_name AS county_name,
         CAST(n_regionkey AS VARCHAR) AS county_fips
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def market_sql(top: int = 24) -> str:
    return f"""
market AS (
  SELECT least(s_nationkey, {top}) AS zip_code, CAST(l_shipdate AS DATE) AS period_end,
         l_quantity AS median_dom, l_quantity * l_linenumber AS inventory,
         1 - l_discount AS avg_sale_to_list, CAST(NULL AS DOUBLE) AS months_of_supply,
         l_extendedprice AS median_sale_price, CAST(l_linenumber AS DOUBLE) AS homes_sold,
         l_tax * 100 AS new_listings
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""


CENSUS = """
census AS (
  SELECT c_nationkey AS zip_code,
         CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS median_household_income,
         CAST(count(*) FILTER (WHERE c_acctbal < 0) AS DOUBLE) AS poverty_count,
         CAST(count(*) AS DOUBLE) AS total_population, 2023 AS vintage_year
  FROM customer GROUP BY 1)"""


def _case(col: str, table: dict[str, str]) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


def crime_sql(areas: int = 25) -> str:
    return f"""
crime AS (
  SELECT CAST(user_id % {areas} AS INTEGER) AS zip_code, ts AS incident_occurred,
         {_case("event_type", OFFENCES)} AS incident_type
  FROM events)"""


HOME_VALUES = f"""
home_values AS (
  SELECT c_nationkey AS zip_code, CAST(o_orderdate AS DATE) AS period_month, o_totalprice AS value,
         {_case("o_orderstatus", METRIC_OF_STATUS)} AS metric_type
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

RATES = """
rates AS (
  SELECT CAST(o_orderdate AS DATE) AS observation_date, o_totalprice AS rate,
         'MORTGAGE30US' AS series_id
  FROM orders)"""


def permits_sql(top: int = 24) -> str:
    return f"""
permits AS (
  SELECT o_custkey AS permit_number, o_orderpriority AS permit_type, o_orderdate AS date_issued,
         least(c_nationkey, {top}) AS zip_code, o_totalprice AS construction_cost
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
