"""Queries for data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from areascore.functions.numbers import floor_round
from areascore.operators.aggregates import summarise_checks
from areascore.operators.checks import (
    check_accepted,
    check_freshness,
    check_grain,
    check_not_null,
    check_null_budget,
    check_range,
    check_unique,
    coverage,
    run_checks,
)
from areascore.operators.reshape import union_all
from areascore.plans import intermediate, marts, staging
from areascore.plans.contracts import CONTRACTS, check_models
from areascore.session import settle
from queries import model_sql as m
from queries import standins as s
from queries.registry import query

_STATUSES = ["F", "O"]


def _results(spark, sf):
    orders, lineitem = s.load(spark, sf, "orders"), s.load(spark, sf, "lineitem")
    events, labels = s.load(spark, sf, "events"), s.load(spark, sf, "labels")
    pending = orders.withColumn("price", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    return union_all(
        [
            run_checks(
                "orders", pending, not_null=["o_orderkey", "price"], unique=["o_orderkey", "o_custkey"],
                accepted={"o_orderstatus": _STATUSES}, ranges={"o_totalprice": (0, 400000)},
                null_budgets={"price": 10},
            ),
            run_checks("lineitem", lineitem, not_null=["l_orderkey"], grains=[["l_orderkey", "l_linenumber"]]),
            run_checks("events", events, not_null=["value"], unique=["event_id"], ranges={"value": (0, 100)}),
            run_checks("labels", labels, unique=["doc_id"], accepted={"quality": [0, 1]}),
        ]
    )


_CHECKS_SQL = """
results AS (
  SELECT "check", violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
    SELECT 'orders.o_orderkey not null' AS "check", count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders
    UNION ALL SELECT 'orders.price not null', count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders
    UNION ALL SELECT 'orders.o_orderstatus accepted', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders
    UNION ALL SELECT 'orders.o_totalprice range', count(*) FILTER (WHERE o_totalprice < 0 OR o_totalprice > 400000) FROM orders
    UNION ALL SELECT 'orders.price null budget',
      CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') > 10 THEN count(*) FILTER (WHERE o_orderstatus = 'P') ELSE 0 END
      FROM orders
    UNION ALL SELECT 'orders.o_orderkey unique', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
    UNION ALL SELECT 'orders.o_custkey unique', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)
    UNION ALL SELECT 'lineitem.l_orderkey not null', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
    UNION ALL SELECT 'lineitem.l_orderkey+l_linenumber grain', count(*)
      FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'events.value not null', count(*) FILTER (WHERE value IS NULL) FROM events
    UNION ALL SELECT 'events.value range', count(*) FILTER (WHERE value < 0 OR value > 100) FROM events
    UNION ALL SELECT 'events.event_id unique', count(*) FROM (SELECT 1 FROM events GROUP BY event_id HAVING count(*) > 1)
    UNION ALL SELECT 'labels.quality accepted', count(*) FILTER (WHERE quality NOT IN (0, 1)) FROM labels
    UNION ALL SELECT 'labels.doc_id unique', count(*) FROM (SELECT 1 FROM labels GROUP BY doc_id HAVING count(*) > 1)))"""


@query(f"WITH {_CHECKS_SQL} SELECT * FROM results")
def quality_checks(spark, sf):
    return _results(spark, sf)


@query(
    f"""WITH {_CHECKS_SQL}
    SELECT count(*) AS tests_run, count(*) FILTER (WHERE status = 'pass') AS tests_passed FROM results"""
)
def check_summary(spark, sf):
    return summarise_checks(_results(spark, sf))


@query(
    """SELECT 'not null' AS rule, count(*) AS n FROM customer WHERE nullif(c_mktsegment, 'BUILDING') IS NULL
    UNION ALL SELECT 'accepted', count(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD')
    UNION ALL SELECT 'range', count(*) FROM customer WHERE c_acctbal < 0 OR c_acctbal > 5000
    UNION ALL SELECT 'unique', count(*) FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'grain', count(*) FROM (SELECT 1 FROM customer GROUP BY c_nationkey, c_mktsegment HAVING count(*) > 1)
    UNION ALL SELECT 'null budget', count(*) FROM
      (SELECT 1 FROM customer HAVING count(*) FILTER (WHERE c_mktsegment = 'BUILDING') > 5)"""
)
def check_rows(spark, sf):
    """Violating rows of each kind of check, counted."""
    customer = s.load(spark, sf, "customer").withColumn(
        "segment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    )
    found = {
        "not null": check_not_null(customer, ["segment"]),
        "accepted": check_accepted(customer, "c_mktsegment", ["BUILDING", "HOUSEHOLD"]),
        "range": check_range(customer, "c_acctbal", 0, 5000),
        "unique": check_unique(customer, "c_nationkey"),
        "grain": check_grain(customer, ["c_nationkey", "c_mktsegment"]),
        "null budget": check_null_budget(customer, "segment", 5),
    }
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n") for rule, df in found.items()]
    )


_NOW = "2024-02-02 06:00:00"


def _age(table: str, col: str, source: str, warn: int, error: int) -> str:
    age = f"(trunc(epoch(TIMESTAMP '{_NOW}') - epoch(max({col}))) / 86400)"
    return f"""SELECT '{source}' AS source, CAST(max({col}) AS TIMESTAMP) AS latest,
      floor({age} * 10000 + 0.5) / 10000 AS age_days,
      CASE WHEN {age} IS NULL OR {age} > {error} THEN 'error' WHEN {age} > {warn} THEN 'warn' ELSE 'pass' END AS status
      FROM {table}"""


@query(
    f"""{_age("events", "ts", "events", 2, 3)} UNION ALL {_age("events", "ts", "events_strict", 1, 3)}
    UNION ALL {_age("orders", "o_orderdate", "orders", 8, 10)}"""
)
def freshness(spark, sf):
    events, orders = s.load(spark, sf, "events"), s.load(spark, sf, "orders")
    sources = [
        (events, "ts", "events", 2, 3),
        (events, "ts", "events_strict", 1, 3),
        (orders, "o_orderdate", "orders", 8, 10),
    ]
    return union_all(
        [
            check_freshness(df, col, warn, error, _NOW).select(
                F.lit(name).alias("source"), "latest",
                floor_round(F.col("age_days"), 4).alias("age_days"), "status",
            )
            for df, col, name, warn, error in sources
        ]
    )


@query(
    """WITH present AS (SELECT DISTINCT s_suppkey AS k FROM supplier)
    SELECT count(*) AS expected, count(*) FILTER (WHERE k IS NULL) AS missing,
           CASE WHEN count(k) < count(*) * 0.9 THEN 'warn' ELSE 'pass' END AS status
    FROM customer LEFT JOIN present ON c_custkey = k""",
    name="coverage",
)
def area_coverage(spark, sf):
    """Customers by number that are suppliers too: most numbers are absent."""
    customer, supplier = s.load(spark, sf, "customer"), s.load(spark, sf, "supplier")
    return coverage(
        supplier.select(F.col("s_suppkey").alias("zip_code")), customer.select(F.col("c_custkey").alias("zip_code")), "zip_code"
    )


# Model -> its relation on the SQL side.
_RELATIONS = {
    "stg_home_values": "home_values",
    "stg_market": "market",
    "stg_crime": "staged_crime",
    "stg_rates": "daily_rates",
    "stg_permits": "staged_permits",
    "zip_demographics": "demographics",
    "market_activity": "activity",
    "crime_index": "crime_index",
    "crime_by_category": "by_category",
    "permit_activity": "permit_activity",
    "monthly_fact": "monthly",
    "geography": "demographics",
    "opportunity_score": "scored",
}
_DAILY_RATES = """
daily_rates AS (
  SELECT * FROM rates QUALIFY row_number() OVER (PARTITION BY observation_date ORDER BY rate) = 1)"""


def _contract_sql() -> str:
    """The declared checks of every model as one union of counts."""
    parts = []

    def add(label: str, expression: str, relation: str) -> None:
        parts.append(f"SELECT '{label}' AS \"check\", {expression} AS violations FROM {relation}")

    for model, relation in _RELATIONS.items():
        rules = CONTRACTS[model]
        for col in rules.get("not_null", ()):
            add(f"{model}.{col} not null", f"count(*) FILTER (WHERE {col} IS NULL)", relation)
        for col, values in rules.get("accepted", {}).items():
            listed = ", ".join(f"'{v}'" for v in values)
            add(f"{model}.{col} accepted", f"count(*) FILTER (WHERE {col} NOT IN ({listed}))", relation)
        for col, (low, high) in rules.get("ranges", {}).items():
            add(f"{model}.{col} range", f"count(*) FILTER (WHERE {col} < {low} OR {col} > {high})", relation)
        for col, budget in rules.get("null_budgets", {}).items():
            nulls = f"count(*) FILTER (WHERE {col} IS NULL)"
            add(f"{model}.{col} null budget", f"CASE WHEN {nulls} > {budget} THEN {nulls} ELSE 0 END", relation)
        for col in rules.get("unique", ()):
            repeated = f"(SELECT 1 FROM {relation} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"
            add(f"{model}.{col} unique", "count(*)", repeated)
        for keys in rules.get("grains", ()):
            repeated = f"(SELECT 1 FROM {relation} GROUP BY {', '.join(keys)} HAVING count(*) > 1)"
            add(f"{model}.{'+'.join(keys)} grain", "count(*)", repeated)
    chain = m.with_(
        *m.SCORE_CHAIN, s.HOME_VALUES, s.RATES, _DAILY_RATES, m.PIVOT, m.MONTHLY_RATE, m.MONTHLY, m.BY_CATEGORY
    )
    counted = " UNION ALL ".join(parts)
    return f"""{chain} SELECT "check", violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM ({counted})"""


@query(_contract_sql())
def declared_checks(spark, sf):
    """The declared checks of the models on the stand-ins. Area-grain models are settled, as the
    tables they would be, since a check may read its model more than once."""
    regions = s.regions(spark, sf)
    market = s.market(spark, sf, s.MARKET_TOP)
    crime = staging.stg_crime(s.crime(spark, sf, s.CRIME_AREAS), regions)
    rates = staging.stg_rates(s.rates(spark, sf))
    permits = staging.stg_permits(s.permits(spark, sf, s.PERMIT_TOP), regions)
    people = settle(intermediate.zip_demographics(s.census(spark, sf), regions, rounding=floor_round))
    activity = settle(intermediate.market_activity(market))
    index = settle(intermediate.crime_index(crime, people, floor_round))
    issued = settle(intermediate.permit_activity(permits, money_scale=2))
    models = {
        "stg_home_values": s.home_values(spark, sf),
        "stg_market": market,
        "stg_crime": crime,
        "stg_rates": rates,
        "stg_permits": permits,
        "zip_demographics": people,
        "market_activity": activity,
        "crime_index": index,
        "crime_by_category": settle(intermediate.crime_by_category(crime, people, floor_round)),
        "permit_activity": issued,
        "monthly_fact": settle(marts.monthly_fact(activity, s.home_values(spark, sf), rates)),
        "geography": marts.geography(people),
        "opportunity_score": settle(marts.opportunity_score(people, activity, index, issued, floor_round)),
    }
    return check_models(models)
