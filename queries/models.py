"""Queries for the models, the score and its labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from areascore.functions.display import badge, display_money, score_channels
from areascore.functions.fixed_values import DEFAULT_CATEGORY, INCIDENT_PATTERNS, SIGNALS
from areascore.functions.numbers import exact_mean, floor_round
from areascore.functions.scores import confidence, minmax_score
from areascore.functions.text import classify
from areascore.operators.aggregates import count_by, grouped_medians, monthly_mean
from areascore.operators.joins import map_features, restrict_to
from areascore.operators.reshape import month_columns, pivot_metrics, unpivot_months
from areascore.operators.windows import latest_per, with_global_stats
from areascore.plans import intermediate, marts, staging
from areascore.plans.reports import reweight
from areascore.session import settle
from queries import model_sql as m
from queries import standins as s
from queries.registry import query


def demographics(spark, sf):
    return intermediate.zip_demographics(s.census(spark, sf), s.regions(spark, sf), rounding=floor_round)


def staged_crime(spark, sf, areas=25):
    return staging.stg_crime(s.crime(spark, sf, areas), s.regions(spark, sf))


def monthly(spark, sf):
    return marts.monthly_fact(
        intermediate.market_activity(s.market(spark, sf)),
        s.home_values(spark, sf),
        staging.stg_rates(s.rates(spark, sf)),
        mean=exact_mean,
        rounding=floor_round,
    )


def combined(spark, sf):
    """One row per area with the latest of each feed, settled because scoring reads it twice."""
    people = demographics(spark, sf)
    permits = staging.stg_permits(s.permits(spark, sf, s.PERMIT_TOP), s.regions(spark, sf))
    return settle(
        marts.latest_signals(
            people,
            s.market(spark, sf, s.MARKET_TOP),
            staged_crime(spark, sf, s.CRIME_AREAS),
            permits,
            floor_round,
            money_scale=2,
        )
    )


@query(f"{m.with_(*m.SCORE_CHAIN)} SELECT * FROM scored")
def opportunity_score(spark, sf):
    return marts.score_areas(combined(spark, sf), floor_round)


@query(f"{m.with_(s.market_sql(), m.ACTIVITY)} SELECT * FROM activity")
def monthly_market_medians(spark, sf):
    return intermediate.market_activity(s.market(spark, sf))


@query(
    """SELECT l_returnflag, l_linestatus, median(l_extendedprice) AS median_price,
              median(l_quantity) AS median_quantity, median(l_discount) AS median_discount,
              count(*) AS n
       FROM lineitem GROUP BY 1, 2"""
)
def hot_group_medians(spark, sf):
    """A few groups that hold the whole table, through the way for groups above the limit."""
    return grouped_medians(
        s.load(spark, sf, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {"median_price": "l_extendedprice", "median_quantity": "l_quantity", "median_discount": "l_discount"},
        rows="n",
        hot_rows=1000,
    )


@query(f"{m.with_(*m.MONTHLY_CHAIN)} SELECT * FROM monthly")
def monthly_fact(spark, sf):
    return monthly(spark, sf)


@query(f"{m.with_(s.HOME_VALUES, m.PIVOT)} SELECT * FROM value_pivot", name="pivot_metrics")
def pivoted(spark, sf):
    return pivot_metrics(s.home_values(spark, sf))


@query(
    f"""{m.with_(s.HOME_VALUES, m.PIVOT)}
    SELECT zip_code, period_month, metric_type, value
    FROM (UNPIVOT value_pivot ON zhvi, zori, zhvf INTO NAME metric_type VALUE value)"""
)
def unpivot_metrics(spark, sf):
    wide = pivot_metrics(s.home_values(spark, sf))
    long = wide.unpivot(["zip_code", "period_month"], ["zhvi", "zori", "zhvf"], "metric_type", "value")
    return long.dropna(subset=["value"])


@query(
    f"""SELECT c_nationkey AS zip_code, {m.month("o_orderdate")} AS period_month,
               max(o_totalprice) AS value, 'ZHVI' AS metric_type
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""
)
def wide_months_to_long(spark, sf):
    """The wide release layout, one column per month, and back to rows."""
    dated = s.home_values(spark, sf).withColumn("month", F.trunc("period_month", "MM"))
    # One value per calendar month in the data.
    span = dated.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    months = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month")))).collect()
    names = [row[0].isoformat() for row in months]
    wide = (
        dated.groupBy("zip_code")
        .pivot("month", [row[0] for row in months])
        .agg(F.max("value"))
    )
    assert month_columns(wide) == names
    return unpivot_months(wide, ["zip_code"], "ZHVI")


@query(f"{m.with_(s.RATES, m.MONTHLY_RATE)} SELECT * FROM monthly_rate")
def rate_monthly_mean(spark, sf):
    rates = staging.stg_rates(s.rates(spark, sf))
    return monthly_mean(rates, "observation_date", "rate", 2, "avg_mortgage_rate", exact_mean, floor_round)


@query(
    f"""SELECT 'event' AS source, {m.category_sql("event_type")} AS category, count(*) AS n FROM events GROUP BY 2
    UNION ALL
    SELECT 'offence', {m.category_sql("incident_type")}, count(*)
    FROM ({m.with_(s.crime_sql())} SELECT * FROM crime) GROUP BY 2
    UNION ALL
    SELECT 'part', {m.category_sql("concat(p_type, ' ', p_name)")}, count(*) FROM part GROUP BY 2"""
)
def classify_incidents(spark, sf):
    events = s.load(spark, sf, "events")
    sources = {
        "event": events.select(F.col("event_type").alias("t")),
        "offence": s.crime(spark, sf).select(F.col("incident_type").alias("t")),
        "part": s.load(spark, sf, "part").select(F.concat_ws(" ", "p_type", "p_name").alias("t")),
    }
    out = None
    for name, df in sources.items():
        labelled = df.select(
            F.lit(name).alias("source"),
            classify(F.col("t"), INCIDENT_PATTERNS, DEFAULT_CATEGORY).alias("category"),
        )
        out = labelled if out is None else out.unionByName(labelled)
    return count_by(out, ["source", "category"])


@query(f"SELECT doc_id, {m.category_sql('text')} AS category FROM documents")
def classify_documents(spark, sf):
    return s.load(spark, sf, "documents").select(
        "doc_id", classify(F.col("text"), INCIDENT_PATTERNS, DEFAULT_CATEGORY).alias("category")
    )


@query(f"{m.with_(*m.CRIME_CHAIN, m.INDEX)} SELECT * FROM crime_index")
def crime_index(spark, sf):
    return intermediate.crime_index(staged_crime(spark, sf), demographics(spark, sf), floor_round)


@query(f"{m.with_(*m.CRIME_CHAIN, m.BY_CATEGORY)} SELECT * FROM by_category")
def crime_by_category(spark, sf):
    return intermediate.crime_by_category(staged_crime(spark, sf), demographics(spark, sf), floor_round)


@query(
    f"""{m.with_(*m.CRIME_CHAIN, m.BY_CATEGORY)}
    SELECT crime_category, zip_code, incidents_per_1k FROM by_category
    QUALIFY row_number() OVER (PARTITION BY crime_category ORDER BY incidents_per_1k DESC, zip_code) = 1"""
)
def crime_top_by_category(spark, sf):
    rates = intermediate.crime_by_category(staged_crime(spark, sf), demographics(spark, sf), floor_round)
    top = latest_per(rates, ["crime_category"], "incidents_per_1k", ["zip_code"])
    return top.select("crime_category", "zip_code", "incidents_per_1k")


@query(f"{m.with_(s.permits_sql(), m.STAGED_PERMITS)} SELECT * FROM staged_permits")
def permit_dedup_latest(spark, sf):
    return staging.stg_permits(s.permits(spark, sf), s.regions(spark, sf))


@query(f"{m.with_(s.permits_sql(), m.STAGED_PERMITS, m.PERMIT_ACTIVITY)} SELECT * FROM permit_activity")
def permit_activity(spark, sf):
    staged = staging.stg_permits(s.permits(spark, sf), s.regions(spark, sf))
    return intermediate.permit_activity(staged, money_scale=2)


@query(f"{m.with_(s.REGIONS, s.CENSUS, m.DEMOGRAPHICS)} SELECT * FROM demographics")
def zip_demographics(spark, sf):
    return demographics(spark, sf)


@query(f"{m.with_(s.REGIONS, s.CENSUS, m.DEMOGRAPHICS)} SELECT * FROM demographics")
def geography(spark, sf):
    return marts.geography(demographics(spark, sf))


@query(
    f"""{m.with_(s.REGIONS, s.market_sql())}
    SELECT zip_code, period_end, median_sale_price, homes_sold FROM market
    WHERE zip_code IN (SELECT zip_code FROM regions WHERE region = 'EUROPE')"""
)
def valid_area_semi_join(spark, sf):
    valid = s.regions(spark, sf).filter("region = 'EUROPE'")
    kept = restrict_to(s.market(spark, sf), valid, "zip_code")
    return kept.select("zip_code", "period_end", "median_sale_price", "homes_sold")


@query(
    f"""{m.with_(s.market_sql())}
    SELECT zip_code, period_end, median_dom, median_sale_price, homes_sold FROM market
    QUALIFY row_number() OVER (PARTITION BY zip_code
      ORDER BY period_end DESC, median_sale_price, median_dom, homes_sold) = 1"""
)
def latest_per_area(spark, sf):
    cols = ["zip_code", "period_end", "median_dom", "median_sale_price", "homes_sold"]
    return latest_per(
        s.market(spark, sf).select(*cols), ["zip_code"], "period_end",
        ["median_sale_price", "median_dom", "homes_sold"],
    )


@query(
    f"""SELECT c_custkey, {m._score("c_acctbal", False)} AS direct_score,
               {m._score("c_acctbal", True)} AS inverted_score FROM customer"""
)
def minmax_scores(spark, sf):
    scored = with_global_stats(s.load(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])
    return scored.select(
        "c_custkey",
        minmax_score("c_acctbal", F.col("stats"), rounding=floor_round).alias("direct_score"),
        minmax_score("c_acctbal", F.col("stats"), "inverted", rounding=floor_round).alias("inverted_score"),
    )


@query(
    f"""WITH counted AS (
      SELECT n_nationkey AS zip_code, CAST(n AS DOUBLE) AS incidents_per_1k, n AS permit_count
      FROM nation LEFT JOIN (SELECT CAST(user_id % 20 AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1)
        ON n_nationkey = k)
    SELECT zip_code, {m.rounded(m._SAFETY)} AS safety_score, {m.rounded(m._PERMIT)} AS permit_score
    FROM counted"""
)
def imputed_scores(spark, sf):
    counts = count_by(s.crime(spark, sf, s.CRIME_AREAS), ["zip_code"], "permit_count")
    areas = s.load(spark, sf, "nation").select(F.col("n_nationkey").alias("zip_code"))
    known = areas.join(counts, "zip_code", "left").withColumn(
        "incidents_per_1k", F.col("permit_count").cast("double")
    )
    scored = with_global_stats(known, ["incidents_per_1k", "permit_count"], marts.EXACT_MEANS)
    return scored.select(
        "zip_code",
        minmax_score(
            "incidents_per_1k", F.col("stats"), "inverted", "mean", True, rounding=floor_round
        ).alias("safety_score"),
        minmax_score("permit_count", F.col("stats"), "direct", "mean", rounding=floor_round).alias("permit_score"),
    )


WEIGHTS = {
    "affordability": 10, "market_speed": 5, "activity": 5, "income": 0, "poverty": 5, "safety": 8, "permits": 2,
}
_WEIGHTED = " + ".join(f"{SIGNALS[k]} * CAST({w} AS DOUBLE)" for k, w in WEIGHTS.items())
_REWEIGHTED = f"""reweighted AS (
  SELECT *, {m.rounded(f"({_WEIGHTED}) / CAST({sum(WEIGHTS.values())} AS DOUBLE)")} AS display_score
  FROM scored)"""


@query(
    f"""{m.with_(*m.SCORE_CHAIN, _REWEIGHTED)}
    SELECT zip_code, display_score, CAST(50 AS DOUBLE) AS unweighted FROM reweighted"""
)
def reweighted_score(spark, sf):
    scores = marts.score_areas(combined(spark, sf), floor_round)
    none = reweight(reweight(scores, WEIGHTS, rounding=floor_round).withColumnRenamed("display_score", "d"),
                    {signal: 0 for signal in SIGNALS})
    return none.select("zip_code", F.col("d").alias("display_score"), F.col("display_score").alias("unweighted"))


@query(
    f"""{m.with_(*m.SCORE_CHAIN)}
    SELECT data_confidence, count(*) AS areas, min(opportunity_score) AS lowest,
           max(opportunity_score) AS highest FROM scored GROUP BY 1"""
)
def confidence_label(spark, sf):
    scores = marts.score_areas(combined(spark, sf), floor_round)
    labelled = scores.withColumn(
        "data_confidence", confidence(F.col("median_sale_price"), F.col("incidents_per_1k"))
    )
    return labelled.groupBy("data_confidence").agg(
        F.count(F.lit(1)).alias("areas"),
        F.min("opportunity_score").alias("lowest"),
        F.max("opportunity_score").alias("highest"),
    )


def _channel(low: int, high: int) -> str:
    t = "(greatest(CAST(0 AS DOUBLE), least(CAST(100 AS DOUBLE), coalesce(score, CAST(50 AS DOUBLE)))) / CAST(100 AS DOUBLE))"
    return f"CAST(floor({low} * (1 - {t}) + {high} * {t}) AS INTEGER)"


_COLOURED = f"{_channel(214, 0)} AS red, {_channel(39, 168)} AS green, {_channel(40, 132)} AS blue"


@query(
    f"""{m.with_(*m.SCORE_CHAIN)}
    SELECT zip_code, {_COLOURED} FROM (SELECT zip_code, safety_score AS score FROM scored)"""
)
def score_colour(spark, sf):
    scores = marts.score_areas(combined(spark, sf), floor_round)
    red, green, blue = score_channels(F.col("safety_score"))
    return scores.select("zip_code", red.alias("red"), green.alias("green"), blue.alias("blue"))


def _money(col: str) -> str:
    whole = f"CAST(floor({col} + 0.5) AS BIGINT)"
    return f"CASE WHEN {col} IS NULL OR {col} = 0 THEN 'N/A' ELSE concat('$', format('{{:,}}', {whole})) END"


@query(
    f"""{m.with_(*m.SCORE_CHAIN, _REWEIGHTED)},
    known AS (SELECT *, true AS found FROM reweighted WHERE data_confidence <> 'Low'),
    joined AS (
      SELECT n.n_nationkey AS zcta, n.n_name AS geometry, k.*,
             CASE WHEN found THEN display_score ELSE CAST(50 AS DOUBLE) END AS score
      FROM nation n LEFT JOIN known k ON n.n_nationkey = k.zip_code)
    SELECT zcta, geometry, {m.rounded("score", 1)} AS display_score, coalesce(region, '—') AS region,
           coalesce(data_confidence, '—') AS data_confidence,
           {_money("median_sale_price")} AS median_sale_price,
           {_money("median_household_income")} AS median_household_income, {_COLOURED}
    FROM joined"""
)
def feature_join(spark, sf):
    scores = reweight(marts.score_areas(combined(spark, sf), floor_round), WEIGHTS, rounding=floor_round)
    shapes = s.load(spark, sf, "nation").select(
        F.col("n_nationkey").alias("zcta"), F.col("n_name").alias("geometry")
    )
    known = scores.filter("data_confidence <> 'Low'")
    out = map_features(shapes, known, rounding=floor_round)
    channels = [F.col("fill_color")[i].alias(c) for i, c in enumerate(("red", "green", "blue"))]
    return out.select(
        "zcta", "geometry", "display_score", "region", "data_confidence", "median_sale_price",
        "median_household_income", *channels,
    )


@query(
    f"""{m.with_(*m.SCORE_CHAIN, _REWEIGHTED)}
    SELECT zip_code, region, county_name, display_score,
           concat(CASE data_confidence WHEN 'High' THEN '🟢' WHEN 'Partial' THEN '🟡' WHEN 'Low' THEN '🔴'
                  ELSE '⚪' END, ' ', data_confidence) AS data_confidence,
           {_money("median_sale_price")} AS price, incidents_per_1k, permit_count
    FROM reweighted"""
)
def map_scorecard(spark, sf):
    scores = reweight(marts.score_areas(combined(spark, sf), floor_round), WEIGHTS, rounding=floor_round)
    return scores.select(
        "zip_code", "region", "county_name", "display_score",
        badge(F.col("data_confidence")).alias("data_confidence"),
        display_money(F.col("median_sale_price")).alias("price"), "incidents_per_1k", "permit_count",
    )
