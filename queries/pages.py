"""The report pages as queries: every part of a page as long rows, next to the same parts in SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions.fixed_values import SIGNALS
from areascore.functions.numbers import floor_round
from areascore.operators.reshape import union_all
from areascore.plans import intermediate, marts, reports
from areascore.session import settle
from queries import model_sql as m
from queries.models import combined, demographics, monthly, staged_crime
from queries.registry import query

#: Digits that figures are rounded to, and the area that pages show.
DIGITS, AREA = 6, 3


def _figures(part: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a figure: part, key of the row, name, and the value as a number or as text; nulls stay."""
    numeric = [c for c, kind in df.dtypes if c not in keys and kind != "string"]
    words = [c for c, kind in df.dtypes if c not in keys and kind == "string"]
    key = F.concat_ws("|", *(F.col(c).cast("string") for c in keys)).alias("key")
    rounded = lambda c: floor_round(F.col(c).cast("double"), DIGITS)
    none = lambda kind: F.lit(None).cast(kind)
    cell = lambda c, number, text: F.struct(F.lit(c).alias("name"), number.alias("number"), text.alias("text"))
    cells = [cell(c, rounded(c), none("string")) for c in numeric] + [cell(c, none("double"), F.col(c)) for c in words]
    return df.select(key, F.explode(F.array(*cells)).alias("c")).select(F.lit(part).alias("part"), "key", "c.*")


def _page(parts: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    return union_all([_figures(name, parts[name], own) for name, own in keys.items()])


def _part(name: str, rel: str, keys: Sequence[str], numbers: Sequence[str] = (), words: Sequence[str] = ()) -> str:
    """SQL twin of ``_figures``."""
    key = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys) or "''"
    each = [f"SELECT '{name}' AS part, {key} AS key, '{c}' AS name, {m.rounded(c, DIGITS)} AS number, CAST(NULL AS VARCHAR) AS text FROM {rel}" for c in numbers]
    each += [f"SELECT '{name}', {key}, '{c}', CAST(NULL AS DOUBLE), CAST({c} AS VARCHAR) FROM {rel}" for c in words]
    return " UNION ALL ".join(each)


_WEIGHTED = " + ".join(f"{column} * CAST(5 AS DOUBLE)" for column in SIGNALS.values())
_SCORES = f"scores AS ({m.with_(*m.SCORE_CHAIN)} SELECT * FROM scored)"
_TABLE = ["display_score", "median_sale_price", "median_household_income", "incidents_per_1k", "permit_count"]
_MAP_SQL = f"""WITH {_SCORES},
  shown AS (SELECT *, {m.rounded(f"({_WEIGHTED}) / CAST({5 * len(SIGNALS)} AS DOUBLE)")} AS display_score FROM scores),
  badged AS (SELECT *, concat(CASE data_confidence WHEN 'High' THEN '🟢' WHEN 'Partial' THEN '🟡' ELSE '🔴' END, ' ', data_confidence) AS data_confidence_shown FROM shown),
  renamed AS (SELECT * EXCLUDE (data_confidence, data_confidence_shown), data_confidence_shown AS data_confidence FROM badged),
  figures AS (
    SELECT CAST(arg_min(zip_code, (-display_score, zip_code)) FILTER (WHERE display_score IS NOT NULL) AS VARCHAR) AS top_zip,
      max(display_score) AS top_score, min(display_score) AS lowest_score FROM shown),
  best AS (SELECT zip_code, display_score FROM shown ORDER BY display_score DESC NULLS LAST, zip_code LIMIT 1)
{_part("table", "renamed", ["zip_code"], _TABLE, ["region", "county_name", "data_confidence"])}
UNION ALL {_part("kpis", "figures", [], ["top_score", "lowest_score"], ["top_zip"])}
UNION ALL {_part("top", "best", ["zip_code"], ["display_score"])}"""


@query(_MAP_SQL)
def map_page(spark, sf):
    scores = settle(marts.score_areas(combined(spark, sf), floor_round))
    page = reports.map_page(scores, rounding=floor_round)
    page["kpis"] = page["kpis"].drop("average_score")  # a mean in the order of the rows
    return _page(page, {"table": ["zip_code"], "kpis": [], "top": ["zip_code"]})


def _pair(col: str) -> str:
    """The area's series next to the median of all, as a relation."""
    return f"""(SELECT a.period_month, a.{col}, e.all_{col} FROM months a
      JOIN (SELECT period_month, median({col}) AS all_{col} FROM months GROUP BY 1) e USING (period_month)
      WHERE zip_code = {AREA} AND a.{col} IS NOT NULL AND e.all_{col} IS NOT NULL)"""


def _latest(cols: Sequence[str]) -> str:
    picks = ", ".join(f"arg_max({c}, period_month) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in cols)
    return f"(SELECT zip_code, {picks} FROM months GROUP BY 1)"


_MONTHS = f"months AS ({m.with_(*m.MONTHLY_CHAIN)} SELECT * FROM monthly)"
_AFFORDABILITY_SQL = f"""WITH {_MONTHS}, {_SCORES},
  trend AS (SELECT period_month, median(zhvi) AS zhvi, median(median_sale_price) AS median_sale_price, max(avg_mortgage_rate) AS avg_mortgage_rate
    FROM months GROUP BY 1),
  latest AS (SELECT arg_max(zhvi, period_month) FILTER (WHERE zhvi IS NOT NULL) AS zhvi,
    arg_max(avg_mortgage_rate, period_month) FILTER (WHERE avg_mortgage_rate IS NOT NULL) AS avg_mortgage_rate FROM trend),
  figures AS (SELECT median(median_sale_price) AS median_sale_price, median(median_household_income) AS median_household_income FROM scores),
  regions_ AS (SELECT region, median(median_sale_price) AS median_sale_price FROM scores WHERE median_sale_price IS NOT NULL GROUP BY 1)
{_part("trend", "trend", ["period_month"], ["zhvi", "median_sale_price", "avg_mortgage_rate"])}
UNION ALL {_part("value_trend", "(SELECT * FROM trend WHERE zhvi IS NOT NULL)", ["period_month"], ["zhvi"])}
UNION ALL {_part("rate_trend", "(SELECT * FROM trend WHERE avg_mortgage_rate IS NOT NULL)", ["period_month"], ["avg_mortgage_rate"])}
UNION ALL {_part("latest", "latest", [], ["zhvi", "avg_mortgage_rate"])}
UNION ALL {_part("kpis", "figures", [], ["median_sale_price", "median_household_income"])}
UNION ALL {_part("region_prices", "regions_", ["region"], ["median_sale_price"])}
UNION ALL {_part("area", _pair("zhvi"), ["period_month"], ["zhvi", "all_zhvi"])}"""


@query(_AFFORDABILITY_SQL)
def affordability_page(spark, sf):
    page = reports.affordability_page(settle(monthly(spark, sf)), combined(spark, sf), AREA)
    page["value_trend"] = page["value_trend"].select("period_month", "zhvi")
    page["rate_trend"] = page["rate_trend"].select("period_month", "avg_mortgage_rate")
    month = ["period_month"]
    keys = {"trend": month, "value_trend": month, "rate_trend": month, "latest": [], "kpis": [], "region_prices": ["region"], "area": month}
    return _page(page, keys)


_STOCK = ["median_inventory", "computed_months_of_supply", "median_new_listings"]
_INVENTORY_SQL = f"""WITH {_MONTHS},
  trend AS (SELECT period_month, median(median_inventory) AS median_inventory, median(computed_months_of_supply) AS months_of_supply,
    median(median_new_listings) AS new_listings FROM months GROUP BY 1),
  figures AS (SELECT median(median_inventory) AS inventory, median(computed_months_of_supply) AS months_of_supply,
    median(median_new_listings) AS new_listings FROM {_latest(_STOCK)})
{_part("kpis", "figures", [], ["inventory", "months_of_supply", "new_listings"])}
UNION ALL {_part("trend", "trend", ["period_month"], ["median_inventory", "months_of_supply", "new_listings"])}
UNION ALL {_part("supply_trend", "(SELECT * FROM trend WHERE months_of_supply IS NOT NULL)", ["period_month"], ["median_inventory", "months_of_supply", "new_listings"])}
UNION ALL {_part("area_inventory", _pair("median_inventory"), ["period_month"], ["median_inventory", "all_median_inventory"])}
UNION ALL {_part("area_supply", _pair("computed_months_of_supply"), ["period_month"], ["computed_months_of_supply", "all_computed_months_of_supply"])}"""


@query(_INVENTORY_SQL)
def inventory_page(spark, sf):
    page = reports.inventory_page(settle(monthly(spark, sf)), AREA)
    month = ["period_month"]
    return _page(page, {"kpis": [], "trend": month, "supply_trend": month, "area_inventory": month, "area_supply": month})


_MOMENTUM = ["median_dom", "median_avg_sale_to_list", "median_sale_price"]
_MOMENTUM_SQL = f"""WITH {_MONTHS},
  trend AS (SELECT period_month, median(median_dom) AS median_dom, median(median_avg_sale_to_list) AS median_avg_sale_to_list FROM months GROUP BY 1),
  figures AS (SELECT {", ".join(f"median({c}) AS {c}" for c in _MOMENTUM)} FROM {_latest(_MOMENTUM)})
{_part("kpis", "figures", [], _MOMENTUM)}
UNION ALL {_part("trend", "trend", ["period_month"], _MOMENTUM[:2])}
UNION ALL {_part("area", _pair("median_dom"), ["period_month"], ["median_dom", "all_median_dom"])}"""


@query(_MOMENTUM_SQL)
def momentum_page(spark, sf):
    page = reports.momentum_page(settle(monthly(spark, sf)), AREA)
    return _page(page, {"kpis": [], "trend": ["period_month"], "area": ["period_month"]})


_TRANSACTIONS_SQL = f"""WITH {_MONTHS}, {_SCORES},
  figures AS (SELECT median(median_homes_sold) AS homes_sold, median(CAST(permit_count AS DOUBLE)) AS permits,
    CAST(arg_min(zip_code, (-permit_count, zip_code)) FILTER (WHERE permit_count IS NOT NULL) AS VARCHAR) AS top_permit_zip FROM scores),
  trend AS (SELECT period_month, median(median_homes_sold) AS median_homes_sold FROM months GROUP BY 1),
  busy AS (SELECT zip_code, region, permit_count FROM scores WHERE permit_count > 0 ORDER BY permit_count DESC, zip_code LIMIT 20)
{_part("kpis", "figures", [], ["homes_sold", "permits"], ["top_permit_zip"])}
UNION ALL {_part("trend", "trend", ["period_month"], ["median_homes_sold"])}
UNION ALL {_part("area", f"(SELECT * FROM months WHERE zip_code = {AREA} AND median_homes_sold IS NOT NULL)", ["period_month"], ["median_homes_sold"])}
UNION ALL {_part("permits", "busy", ["zip_code"], ["permit_count"], ["region"])}"""


@query(_TRANSACTIONS_SQL)
def transactions_page(spark, sf):
    page = reports.transactions_page(settle(monthly(spark, sf)), combined(spark, sf), AREA)
    return _page(page, {"kpis": [], "trend": ["period_month"], "area": ["period_month"], "permits": ["zip_code"]})


_CRIME_SQL = f"""{m.with_(*m.CRIME_CHAIN, m.INDEX, m.BY_CATEGORY)}, {_SCORES},
  known AS (SELECT zip_code, region, incidents_per_1k FROM scores WHERE incidents_per_1k IS NOT NULL),
  rates AS (SELECT b.zip_code, r.region, incident_year, incident_count, incidents_per_1k FROM by_category b
    JOIN regions r ON b.zip_code = r.zip_code WHERE crime_category = 'Violent'),
  figures AS (SELECT median(incidents_per_1k) AS median_rate, CAST(arg_min(zip_code, (incidents_per_1k, zip_code)) AS VARCHAR) AS safest_zip,
    CAST(arg_min(zip_code, (-incidents_per_1k, zip_code)) AS VARCHAR) AS highest_zip FROM known),
  trend AS (SELECT incident_year, median(incidents_per_1k) AS all_median FROM rates WHERE incidents_per_1k IS NOT NULL GROUP BY 1),
  by_region AS (SELECT region, median(incidents_per_1k) AS incidents_per_1k FROM known GROUP BY 1),
  highest AS (SELECT * FROM known ORDER BY incidents_per_1k DESC, zip_code LIMIT 30)
{_part("kpis", "figures", [], ["median_rate"], ["safest_zip", "highest_zip"])}
UNION ALL {_part("areas", "highest", ["zip_code"], ["incidents_per_1k"], ["region"])}
UNION ALL {_part("trend", "trend", ["incident_year"], ["all_median"])}
UNION ALL {_part("regions", "by_region", ["region"], ["incidents_per_1k"])}
UNION ALL {_part("category_rates", "rates", ["zip_code", "incident_year"], ["incident_count", "incidents_per_1k"], ["region"])}"""


@query(_CRIME_SQL)
def crime_page(spark, sf):
    people = settle(demographics(spark, sf))
    incidents = staged_crime(spark, sf)
    index = intermediate.crime_index(incidents, people, floor_round)
    by_category = intermediate.crime_by_category(incidents, people, floor_round)
    page = reports.crime_page(combined(spark, sf), index, by_category, "Violent")
    keys = {"kpis": [], "areas": ["zip_code"], "trend": ["incident_year"], "regions": ["region"], "category_rates": ["zip_code", "incident_year"]}
    return _page(page, keys)
