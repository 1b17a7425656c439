"""SQL text of the models on the stand-ins, for the oracle side."""

from __future__ import annotations

from areascore.functions.fixed_values import DEFAULT_CATEGORY, INCIDENT_PATTERNS
from queries import standins as s


def rounded(x: str, digits: int = 2) -> str:
    scale = f"CAST({10**digits} AS DOUBLE)"
    return f"(floor(CAST({x} AS DOUBLE) * {scale} + CAST(0.5 AS DOUBLE)) / {scale})"


def month(x: str) -> str:
    return f"CAST(date_trunc('month', {x}) AS DATE)"


def category_sql(col: str) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"{col} ILIKE '{p}'" for p in patterns) + f" THEN '{name}'"
        for name, patterns in INCIDENT_PATTERNS.items()
    )
    return f"CASE {cases} ELSE '{DEFAULT_CATEGORY}' END"


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


DEMOGRAPHICS = f"""
demographics AS (
  SELECT c.zip_code, region, county_name, county_fips, median_household_income, poverty_count,
         total_population, {rounded("poverty_count / nullif(total_population, 0)", 4)} AS poverty_rate,
         vintage_year
  FROM census c JOIN regions r ON c.zip_code = r.zip_code WHERE vintage_year = 2023)"""

ACTIVITY = f"""
activity AS (
  SELECT zip_code, {month("period_end")} AS period_month, median(median_dom) AS median_dom,
         median(inventory) AS median_inventory, median(avg_sale_to_list) AS median_avg_sale_to_list,
         median(months_of_supply) AS median_months_of_supply,
         median(median_sale_price) AS median_sale_price, median(homes_sold) AS median_homes_sold,
         median(new_listings) AS median_new_listings, count(*) AS week_count
  FROM market GROUP BY 1, 2)"""

STAGED_CRIME = f"""
staged_crime AS (
  SELECT zip_code, incident_occurred, incident_type, {category_sql("incident_type")} AS crime_category
  FROM crime)"""

INDEX = f"""
crime_index AS (
  SELECT a.zip_code, incident_year, incident_count, total_population,
         {rounded("CAST(incident_count AS DOUBLE) / nullif(total_population, 0) * 1000")} AS incidents_per_1k
  FROM (SELECT zip_code, CAST(year(incident_occurred) AS INTEGER) AS incident_year, count(*) AS incident_count
        FROM staged_crime WHERE crime_category <> 'Administrative' GROUP BY 1, 2) a
  JOIN demographics d ON a.zip_code = d.zip_code)"""

BY_CATEGORY = f"""
by_category AS (
  SELECT a.zip_code, incident_year, crime_category, incident_count, total_population,
         {rounded("CAST(incident_count AS DOUBLE) / nullif(total_population, 0) * 1000")} AS incidents_per_1k
  FROM (SELECT zip_code, CAST(year(incident_occurred) AS INTEGER) AS incident_year, crime_category,
               count(*) AS incident_count
        FROM staged_crime WHERE crime_category <> 'Administrative' GROUP BY 1, 2, 3) a
  JOIN demographics d ON a.zip_code = d.zip_code)"""

STAGED_PERMITS = """
staged_permits AS (
  SELECT * FROM permits
  QUALIFY row_number() OVER (PARTITION BY permit_number
    ORDER BY date_issued DESC, zip_code, permit_type, construction_cost DESC) = 1)"""

PERMIT_ACTIVITY = """
permit_activity AS (
  SELECT zip_code, CAST(year(date_issued) AS INTEGER) AS permit_year, count(*) AS permit_count,
         CAST(sum(CAST(construction_cost AS DECIMAL(18,2))) AS DOUBLE) AS total_construction_cost
  FROM staged_permits WHERE date_issued IS NOT NULL GROUP BY 1, 2)"""

PIVOT = f"""
value_pivot AS (
  SELECT zip_code, {month("period_month")} AS period_month,
         max(CASE WHEN metric_type = 'ZHVI' THEN value END) AS zhvi,
         max(CASE WHEN metric_type = 'ZORI' THEN value END) AS zori,
         max(CASE WHEN metric_type = 'ZHVF' THEN value END) AS zhvf
  FROM home_values GROUP BY 1, 2)"""

MONTHLY_RATE = f"""
monthly_rate AS (
  SELECT {month("observation_date")} AS period_month,
         {rounded("CAST(sum(CAST(rate AS DECIMAL(28,2))) AS DOUBLE) / count(rate)")} AS avg_mortgage_rate
  FROM (SELECT * FROM rates
        QUALIFY row_number() OVER (PARTITION BY observation_date ORDER BY rate) = 1) d
  GROUP BY 1)"""

MONTHLY = """
monthly AS (
  SELECT m.zip_code, m.period_month, median_dom, median_inventory, median_avg_sale_to_list,
         median_months_of_supply, median_sale_price, median_homes_sold, median_new_listings,
         median_inventory / nullif(median_homes_sold, 0) AS computed_months_of_supply, week_count,
         zhvi, zori, zhvf, avg_mortgage_rate
  FROM activity m
  LEFT JOIN value_pivot z ON m.zip_code = z.zip_code AND m.period_month = z.period_month
  LEFT JOIN monthly_rate f ON m.period_month = f.period_month)"""


def _score(col: str, inverted: bool) -> str:
    share = f"({col} - min({col}) OVER ()) / nullif(max({col}) OVER () - min({col}) OVER (), 0)"
    return rounded(f"({'1 - ' + share if inverted else share}) * 100")


_MEAN_RATE = "(CAST(sum(CAST(incidents_per_1k AS DECIMAL(28,2))) OVER () AS DOUBLE) / count(incidents_per_1k) OVER ())"
_SAFETY = (
    f"(1 - (coalesce(incidents_per_1k, {_MEAN_RATE}) - min(coalesce(incidents_per_1k, 0)) OVER ())"
    " / nullif(max(incidents_per_1k) OVER () - min(incidents_per_1k) OVER (), 0)) * 100"
)
_PERMIT = (
    "((coalesce(CAST(permit_count AS DOUBLE), avg(permit_count) OVER ()) - min(permit_count) OVER ())"
    " / nullif(max(permit_count) OVER () - min(permit_count) OVER (), 0)) * 100"
)

# The score from its rules: every signal runs from its lowest to its highest value over all areas, the span; a
# signal where little is good counts from the top; missing safety and permit signals take the mean.
_SPANNED = ["median_sale_price", "median_dom", "median_homes_sold", "median_household_income", "poverty_rate", "incidents_per_1k", "permit_count"]
_SPAN = ", ".join(f"min({c}) AS {c}_low, max({c}) AS {c}_high" for c in _SPANNED)


def _share(value: str, col: str, low: str | None = None) -> str:
    return f"({value} - {low or f'{col}_low'}) / nullif({col}_high - {col}_low, 0)"


_RULES = {
    "affordability": f"1 - {_share('median_sale_price', 'median_sale_price')}",
    "market_speed": f"1 - {_share('median_dom', 'median_dom')}",
    "activity": _share("median_homes_sold", "median_homes_sold"),
    "income": _share("median_household_income", "median_household_income"),
    "poverty": f"1 - {_share('poverty_rate', 'poverty_rate')}",
    "safety": f"1 - {_share('coalesce(incidents_per_1k, mean_incidents)', 'incidents_per_1k', 'incidents_or_0_low')}",
    "permit": _share("coalesce(CAST(permit_count AS DOUBLE), mean_permits)", "permit_count"),
}
_SUM = " + ".join(f"coalesce({name}_score, CAST(50 AS DOUBLE))" for name in _RULES)

SCORED = f"""
areas AS (
  SELECT d.zip_code, region, county_name, county_fips, market_as_of, crime_as_of,
         market.price AS median_sale_price, market.dom AS median_dom, market.sold AS median_homes_sold,
         median_household_income, poverty_rate, incidents_per_1k,
         permit_year, permits.n AS permit_count, permits.cost AS total_construction_cost
  FROM demographics d
  LEFT JOIN (
    SELECT zip_code, max(period_month) AS market_as_of,
           arg_max({{'price': median_sale_price, 'dom': median_dom, 'sold': median_homes_sold}}, period_month) AS market
    FROM activity GROUP BY zip_code) USING (zip_code)
  LEFT JOIN (
    SELECT zip_code, max(incident_year) AS crime_as_of,
           arg_max({{'rate': incidents_per_1k}}, incident_year).rate AS incidents_per_1k
    FROM crime_index GROUP BY zip_code) USING (zip_code)
  LEFT JOIN (
    SELECT zip_code, max(permit_year) AS permit_year,
           arg_max({{'n': permit_count, 'cost': total_construction_cost}}, permit_year) AS permits
    FROM permit_activity GROUP BY zip_code) USING (zip_code)),
span AS (
  SELECT {_SPAN}, min(coalesce(incidents_per_1k, 0)) AS incidents_or_0_low, avg(permit_count) AS mean_permits,
         CAST(sum(CAST(incidents_per_1k AS DECIMAL(28,2))) AS DOUBLE) / count(incidents_per_1k) AS mean_incidents
  FROM areas),
rated AS (
  SELECT areas.*, {", ".join(f"{rounded(f'({rule}) * 100')} AS {name}_score" for name, rule in _RULES.items())}
  FROM areas CROSS JOIN span),
scored AS (
  SELECT *, {rounded(f"({_SUM}) / 7")} AS opportunity_score,
         ['High', 'Partial', 'Low'][1 + (median_sale_price IS NULL)::INT + (incidents_per_1k IS NULL)::INT] AS data_confidence
  FROM rated)"""

CRIME_CHAIN = [s.REGIONS, s.CENSUS, DEMOGRAPHICS, s.crime_sql(), STAGED_CRIME]
MONTHLY_CHAIN = [s.market_sql(), s.HOME_VALUES, s.RATES, ACTIVITY, PIVOT, MONTHLY_RATE, MONTHLY]
SCORE_CHAIN = [
    s.REGIONS, s.CENSUS, DEMOGRAPHICS, s.market_sql(s.MARKET_TOP), ACTIVITY, s.crime_sql(s.CRIME_AREAS),
    STAGED_CRIME, INDEX, s.permits_sql(s.PERMIT_TOP), STAGED_PERMITS, PERMIT_ACTIVITY, SCORED,
]
