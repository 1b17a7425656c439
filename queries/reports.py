"""Queries behind the report pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from areascore.functions.display import status_icon
from areascore.functions.numbers import floor_round
from areascore.operators.aggregates import (
    all_area_monthly,
    extreme_area,
    grouped_medians,
    kpis,
    latest_nonnull,
    median_by,
)
from areascore.operators.filters import positive_only
from areascore.operators.joins import against_all, with_supply
from areascore.operators.ordering import top_n
from areascore.operators.reshape import unpivot_freshness
from areascore.operators.windows import latest_per
from areascore.plans import intermediate, reports
from areascore.session import settle
from queries import model_sql as m
from queries import standins as s
from queries.models import combined, demographics, monthly, permit_activity, staged_crime
from queries.registry import query


@query(
    f"""{m.with_(s.market_sql(), m.ACTIVITY)},
    everyone AS (SELECT period_month, median(median_dom) AS all_median_dom FROM activity GROUP BY 1)
    SELECT a.period_month, median_dom, all_median_dom
    FROM activity a JOIN everyone e ON a.period_month = e.period_month
    WHERE zip_code = (SELECT min(zip_code) FROM activity)
      AND median_dom IS NOT NULL AND all_median_dom IS NOT NULL"""
)
def area_vs_all_series(spark, sf):
    activity = settle(intermediate.market_activity(s.market(spark, sf)).select("zip_code", "period_month", "median_dom"))
    return against_all(activity, activity.agg(F.min("zip_code")).head()[0], "median_dom")


_LATEST = ["median_inventory", "median_sale_price", "zhvi", "zori", "zhvf"]


@query(
    f"""{m.with_(*m.MONTHLY_CHAIN)}
    SELECT zip_code, {", ".join(f"arg_max({c}, period_month) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _LATEST)}
    FROM monthly GROUP BY 1"""
)
def latest_nonnull_per_column(spark, sf):
    return latest_nonnull(monthly(spark, sf), "zip_code", "period_month", _LATEST)


@query(
    """SELECT r_name AS region, median(c_acctbal) AS c_acctbal
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       GROUP BY 1"""
)
def region_medians(spark, sf):
    customers = s.load(spark, sf, "customer").withColumnRenamed("c_nationkey", "zip_code")
    return median_by(customers.join(s.regions(spark, sf), "zip_code"), "region", "c_acctbal")


@query(
    f"""WITH per_area AS (
      SELECT c_nationkey AS zip_code, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
    SELECT year, median(CAST(n AS DOUBLE)) AS median_orders FROM per_area GROUP BY 1"""
)
def yearly_median_rate(spark, sf):
    per_area = (
        s.home_values(spark, sf)
        .groupBy("zip_code", F.year("period_month").alias("year"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return median_by(per_area, "year", "n", "median_orders")


@query(
    f"""{m.with_(s.market_sql(), m.ACTIVITY)},
    latest AS (
      SELECT * FROM activity QUALIFY row_number() OVER (PARTITION BY zip_code ORDER BY period_month DESC) = 1)
    SELECT median(median_sale_price) AS median_price, min(median_dom) AS lowest_dom,
           max(median_dom) AS highest_dom, count(*) AS areas,
           CAST(arg_min(zip_code, (median_sale_price, zip_code)) AS VARCHAR) AS cheapest,
           CAST(arg_min(zip_code, (-median_sale_price, zip_code)) AS VARCHAR) AS dearest
    FROM latest"""
)
def kpi_summary(spark, sf):
    activity = intermediate.market_activity(s.market(spark, sf))
    latest = settle(
        latest_per(activity, ["zip_code"], "period_month").select("zip_code", "median_sale_price", "median_dom")
    )
    return kpis(
        latest,
        {
            "median_price": ("median", "median_sale_price"),
            "lowest_dom": F.min("median_dom"),
            "highest_dom": F.max("median_dom"),
            "areas": F.count(F.lit(1)),
            "cheapest": extreme_area(latest, "median_sale_price", "min"),
            "dearest": extreme_area(latest, "median_sale_price", "max"),
        },
    )


@query(
    f"""{m.with_(s.permits_sql(), m.STAGED_PERMITS, m.PERMIT_ACTIVITY)}
    SELECT zip_code, permit_year, permit_count FROM permit_activity WHERE permit_count > 0
    ORDER BY permit_count DESC, zip_code, permit_year LIMIT 20"""
)
def top_n_areas(spark, sf):
    counts = positive_only(permit_activity(spark, sf), "permit_count")
    top = top_n(counts, "permit_count", 20, ["zip_code", "permit_year"])
    return top.select("zip_code", "permit_year", "permit_count")


@query(
    f"""{m.with_(*m.MONTHLY_CHAIN)}
    SELECT period_month, median(zhvi) AS zhvi, median(median_sale_price) AS median_sale_price,
           max(avg_mortgage_rate) AS avg_mortgage_rate
    FROM monthly GROUP BY 1"""
)
def affordability_trend(spark, sf):
    return all_area_monthly(
        settle(monthly(spark, sf).select("period_month", "zhvi", "median_sale_price", "avg_mortgage_rate")),
        {"zhvi": "zhvi", "median_sale_price": "median_sale_price"},
        {"avg_mortgage_rate": "avg_mortgage_rate"},
    )


@query(
    f"""{m.with_(*m.MONTHLY_CHAIN)},
    everyone AS (
      SELECT period_month, median(zhvi) AS zhvi, max(avg_mortgage_rate) AS avg_mortgage_rate FROM monthly GROUP BY 1)
    SELECT arg_max(zhvi, period_month) FILTER (WHERE zhvi IS NOT NULL) AS zhvi,
           arg_max(avg_mortgage_rate, period_month) FILTER (WHERE avg_mortgage_rate IS NOT NULL) AS avg_mortgage_rate
    FROM everyone"""
)
def affordability_latest(spark, sf):
    trend = affordability_trend(spark, sf)
    return latest_nonnull(trend, None, "period_month", ["zhvi", "avg_mortgage_rate"])


@query(
    f"""{m.with_(*m.SCORE_CHAIN)}
    SELECT region, median(median_sale_price) AS median_sale_price FROM scored
    WHERE median_sale_price IS NOT NULL GROUP BY 1"""
)
def affordability_regions(spark, sf):
    return median_by(combined(spark, sf), "region", "median_sale_price")


_INVENTORY = ["median_inventory", "computed_months_of_supply", "median_new_listings"]


@query(
    f"""{m.with_(s.market_sql(), m.ACTIVITY)},
    supplied AS (SELECT *, median_inventory / nullif(median_homes_sold, 0) AS computed_months_of_supply FROM activity),
    latest AS (
      SELECT zip_code, {", ".join(f"arg_max({c}, period_month) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _INVENTORY)}
      FROM supplied GROUP BY 1)
    SELECT median(median_inventory) AS inventory, {m.rounded("median(computed_months_of_supply)", 6)} AS months_of_supply,
           median(median_new_listings) AS new_listings FROM latest"""
)
def inventory_kpis(spark, sf):
    activity = with_supply(intermediate.market_activity(s.market(spark, sf)))
    latest = settle(latest_nonnull(activity, "zip_code", "period_month", _INVENTORY))
    figures = kpis(
        latest,
        {
            "inventory": ("median", "median_inventory"),
            "months_of_supply": ("median", "computed_months_of_supply"),
            "new_listings": ("median", "median_new_listings"),
        },
    )
    return figures.withColumn("months_of_supply", floor_round(F.col("months_of_supply"), 6))


@query(
    f"""{m.with_(*m.CRIME_CHAIN, m.BY_CATEGORY)}
    SELECT region, median(incidents_per_1k) AS incidents_per_1k
    FROM by_category b JOIN regions r ON b.zip_code = r.zip_code
    WHERE crime_category = 'Violent' AND incidents_per_1k IS NOT NULL GROUP BY 1"""
)
def crime_regions_of_category(spark, sf):
    people = settle(demographics(spark, sf))
    incidents = staged_crime(spark, sf)
    rates = reports.crime_rates(
        intermediate.crime_index(incidents, people, floor_round),
        intermediate.crime_by_category(incidents, people, floor_round),
        people,
        "Violent",
    )
    return median_by(rates, "region", "incidents_per_1k")


@query(
    f"""{m.with_(*m.SCORE_CHAIN)}
    SELECT zip_code, region, incidents_per_1k FROM scored WHERE incidents_per_1k IS NOT NULL
    ORDER BY incidents_per_1k DESC, zip_code LIMIT 30"""
)
def crime_top_areas(spark, sf):
    known = combined(spark, sf).dropna(subset=["incidents_per_1k"])
    return top_n(known, "incidents_per_1k", 30).select("zip_code", "region", "incidents_per_1k")


@query(
    f"""{m.with_(s.market_sql(), m.ACTIVITY)}
    SELECT period_month, median(median_dom) AS median_dom,
           {m.rounded("median(median_avg_sale_to_list)", 6)} AS median_avg_sale_to_list
    FROM activity GROUP BY 1"""
)
def momentum_trend(spark, sf):
    activity = settle(
        intermediate.market_activity(s.market(spark, sf)).select(
            "period_month", "median_dom", "median_avg_sale_to_list"
        )
    )
    trend = all_area_monthly(activity, {c: c for c in ("median_dom", "median_avg_sale_to_list")})
    return trend.withColumn("median_avg_sale_to_list", floor_round(F.col("median_avg_sale_to_list"), 6))


@query(
    f"""{m.with_(*m.SCORE_CHAIN)}
    SELECT median(median_homes_sold) AS homes_sold, median(CAST(permit_count AS DOUBLE)) AS permits,
           CAST(arg_min(zip_code, (-permit_count, zip_code)) FILTER (WHERE permit_count IS NOT NULL) AS VARCHAR)
             AS top_permit_zip FROM scored"""
)
def transactions_kpis(spark, sf):
    scores = combined(spark, sf)
    return kpis(
        scores,
        {
            "homes_sold": ("median", "median_homes_sold"),
            "permits": ("median", "permit_count"),
            "top_permit_zip": extreme_area(scores, "permit_count", "max"),
        },
    )


def _audit(spark, sf):
    """Audit rows from events: one run per event."""
    k = F.from_json("props", "k int")["k"]
    status = F.when(F.col("event_type") == "error", "failure").otherwise("success")
    mark = F.when(F.col("value") > 20, "error").when(F.col("value") > 10, "warn").otherwise("pass")
    return s.load(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").cast("timestamp_ntz").alias("run_timestamp"),
        F.col("event_type").alias("job_name"),
        status.alias("status"),
        F.when(F.col("event_type") != "view", F.lit(100)).alias("tests_run"),
        k.alias("tests_passed"),
        mark.alias("freshness_market"),
        F.when(F.col("event_type") != "click", mark).alias("freshness_crime"),
    )


_AUDIT_SQL = """
audit AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, ts AS run_timestamp, event_type AS job_name,
         CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status,
         CASE WHEN event_type <> 'view' THEN 100 END AS tests_run,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS tests_passed,
         CASE WHEN value > 20 THEN 'error' WHEN value > 10 THEN 'warn' ELSE 'pass' END AS freshness_market,
         CASE WHEN event_type <> 'click' THEN
           CASE WHEN value > 20 THEN 'error' WHEN value > 10 THEN 'warn' ELSE 'pass' END END AS freshness_crime
  FROM events)"""


@query(
    f"""{m.with_(_AUDIT_SQL)}
    SELECT strftime(run_timestamp, '%Y-%m-%d %H:%M') AS last_run, job_name, upper(status) AS status,
           CASE WHEN tests_run IS NULL THEN 'N/A' ELSE concat(tests_passed, '/', tests_run) END AS tests
    FROM (SELECT * FROM audit ORDER BY run_timestamp DESC, run_id LIMIT 30)"""
)
def health_last_runs(spark, sf):
    return reports.audit_display(top_n(_audit(spark, sf), "run_timestamp", reports.RUNS_SHOWN, ["run_id"]))


@query(
    f"""{m.with_(_AUDIT_SQL)}, last AS (SELECT * FROM audit ORDER BY run_timestamp DESC, run_id LIMIT 1)
    SELECT source, status,
           coalesce(concat(CASE status WHEN 'pass' THEN '✅' WHEN 'warn' THEN '⚠️' ELSE '❓' END, ' ', status), 'N/A')
             AS shown
    FROM (SELECT 'market' AS source, freshness_market AS status FROM last
          UNION ALL SELECT 'crime', freshness_crime FROM last)"""
)
def health_freshness(spark, sf):
    last = top_n(_audit(spark, sf), "run_timestamp", 1, ["run_id"])
    return unpivot_freshness(last).withColumn("shown", status_icon(F.col("status")))


@query(
    """SELECT event_type, median(value) AS median_value, count(*) AS n FROM events GROUP BY 1"""
)
def event_medians(spark, sf):
    return grouped_medians(s.load(spark, sf, "events"), ["event_type"], {"median_value": "value"}, rows="n")
