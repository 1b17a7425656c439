"""Queries for filters, casts, codes, state and range replacement."""

from __future__ import annotations

from pyspark.sql import functions as F

from areascore.functions.fixed_values import CENSUS_MISSING
from areascore.functions.numbers import floor_round, null_if_sentinel, to_double
from areascore.functions.text import (
    area_from_label,
    blank_as_zero,
    clean_code,
    code_text,
    concat_fips,
    region_of,
    zip_from_float_text,
)
from areascore.functions.times import (
    from_epoch_ms_local,
    from_epoch_ms_seconds,
    iso_date,
    lookback_bound,
    month_of,
    to_epoch_ms,
    year_of,
)
from areascore.plans.ingest import TIME_FORMAT, fetch_ranges, last_fetch_wins
from areascore.operators.aggregates import count_by, count_loss, high_water, periods
from areascore.operators.filters import (
    drop_all_null,
    drop_blank,
    drop_null,
    drop_sentinel,
    from_bound,
    in_code_range,
    keep_codes,
    keep_state,
    newer_than,
    newer_versions,
    pin_vintage,
    valid_sales,
)
from areascore.operators.ordering import distinct_sorted
from areascore.operators.reshape import stamp, union_all
from areascore.operators.windows import argmax_by
from areascore.sources.tables import init_state, replace_from, replace_keys
from areascore.streaming.counts import tumbling_counts
from queries import standins as s
from queries.registry import query


@query(
    """WITH supplied AS (
      SELECT l_partkey, s_nationkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS overlap
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
    best AS (
      SELECT * FROM supplied QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY overlap DESC, s_nationkey) = 1),
    placed AS (
      SELECT CASE WHEN s_nationkey = 0 THEN
                    CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'Low'
                         WHEN p_brand IN ('Brand#7', 'Brand#8', 'Brand#9') THEN 'High' ELSE 'Middle' END
                  ELSE n_name END AS region
      FROM best JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)
    SELECT region, count(*) AS areas FROM placed GROUP BY 1"""
)
def region_assignment(spark, sf):
    """Each part goes to the nation that supplies most of it; one nation is split by brand."""
    lineitem, supplier = s.load(spark, sf, "lineitem"), s.load(spark, sf, "supplier")
    supplied = (
        lineitem.join(supplier, lineitem["l_suppkey"] == supplier["s_suppkey"])
        .groupBy("l_partkey", "s_nationkey")
        .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("overlap"))
    )
    best = argmax_by(supplied, "l_partkey", "overlap", ["s_nationkey"])
    part = s.load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    nation = s.load(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    split = {"Low": ["Brand#1", "Brand#2", "Brand#3"], "High": ["Brand#7", "Brand#8", "Brand#9"]}
    inside = region_of(F.col("p_brand"), F.lit(0), {}, 0, split, "Middle")
    placed = best.join(nation, "s_nationkey").join(part, "l_partkey").withColumn(
        "region", F.when(F.col("s_nationkey") == 0, inside).otherwise(F.col("n_name"))
    )
    return count_by(placed, ["region"], "areas")


@query(
    """SELECT l_partkey, l_suppkey, total FROM (
      SELECT l_partkey, l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total
      FROM lineitem GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY total DESC, l_suppkey) = 1"""
)
def relationship_argmax(spark, sf):
    totals = s.load(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("total")
    )
    return argmax_by(totals, "l_partkey", "total", ["l_suppkey"])


_MARK = "2024-01-10"


@query(
    f"""SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE CAST(ts AS DATE) > DATE '{_MARK}' GROUP BY 1"""
)
def high_water_filter(spark, sf):
    days = s.load(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    return count_by(newer_than(days, "day", _MARK), ["day"])


@query("SELECT max(CAST(o_orderdate AS DATE)) AS day FROM orders", name="high_water")
def high_water_mark(spark, sf):
    return high_water(s.load(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day")), "day")


@query("SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS month FROM lineitem", name="periods")
def period_list(spark, sf):
    return periods(s.load(spark, sf, "lineitem").select(month_of(F.col("l_shipdate")).alias("month")), "month")


def _dated_orders(spark, sf):
    return s.load(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", month_of(F.col("o_orderdate")).alias("month"),
        F.col("o_orderdate").cast("date").alias("day"),
    )


@query(
    """WITH dated AS (
      SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS month
      FROM orders),
    fresh AS (SELECT * FROM dated WHERE o_orderstatus = 'P'),
    old AS (SELECT * FROM dated WHERE o_orderstatus <> 'P' OR month < DATE '1997-01-01')
    SELECT month, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (
      SELECT * FROM old WHERE month NOT IN (SELECT month FROM fresh WHERE month >= DATE '1997-01-01')
      UNION ALL SELECT * FROM fresh WHERE month >= DATE '1997-01-01') GROUP BY 1""",
    name="replace_keys",
)
def replaced_keys(spark, sf):
    orders = _dated_orders(spark, sf).drop("day")
    late = F.col("month") >= F.lit("1997-01-01").cast("date")
    pending = F.col("o_orderstatus") == "P"
    out = replace_keys(orders.filter(~pending | ~late), orders.filter(pending & late), "month")
    return out.groupBy("month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )


_STORED = "1999-06-30"


@query(
    """WITH dated AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders),
    target AS (SELECT * FROM dated WHERE o_orderstatus <> 'O'),
    landed AS (SELECT * FROM dated)
    SELECT * FROM target WHERE day < DATE '1999-05-31'
    UNION ALL SELECT * FROM landed WHERE day >= DATE '1999-05-31'"""
)
def replace_from_lookback(spark, sf):
    """The table lacks open orders; a reload from the 30-day lookback brings the recent ones in."""
    dated = _dated_orders(spark, sf).select("o_orderkey", "o_orderstatus", "day")
    bound = lookback_bound(_STORED, 30, "2000-01-01")
    target = dated.filter(F.col("o_orderstatus") != "O")
    return replace_from(target, from_bound(dated, "day", bound), "day", bound)


@query(
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS vintage_year, count(*) AS n,
              year(o_orderdate) = 1999 AS pinned
       FROM orders WHERE year(o_orderdate) > 1996 GROUP BY 1, 3"""
)
def version_select(spark, sf):
    years = s.load(spark, sf, "orders").select(year_of(F.col("o_orderdate")).alias("vintage_year"))
    counts = count_by(newer_versions(years, "vintage_year", "1996"), ["vintage_year"])
    pinned = pin_vintage(counts, 1999).select("vintage_year", F.lit(True).alias("pinned"))
    return counts.join(pinned, "vintage_year", "left").withColumn("pinned", F.coalesce("pinned", F.lit(False)))


_SIZE_MARK = "CASE WHEN p_size < 8 THEN 'NA' ELSE CAST(p_size AS VARCHAR) END"
_PRICE_MARK = f"CASE WHEN p_retailprice < 950 THEN '{CENSUS_MISSING}' ELSE CAST(p_retailprice AS VARCHAR) END"


def _marked_parts(spark, sf):
    """Parts with missing marks in place of small sizes and low prices, blank and other types."""
    return s.load(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_size") < 8, "NA").otherwise(F.col("p_size").cast("string")).alias("size"),
        F.when(F.col("p_retailprice") < 950, CENSUS_MISSING)
        .otherwise(F.col("p_retailprice").cast("string"))
        .alias("price"),
        F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type")).alias("kind"),
    )


@query(
    f"""WITH marked AS (
      SELECT p_partkey, {_SIZE_MARK} AS size, {_PRICE_MARK} AS price,
             CASE WHEN p_type = 'PROMO' THEN '' ELSE p_type END AS kind FROM part)
    SELECT p_partkey, CAST(nullif(size, 'NA') AS DOUBLE) AS size, CAST(nullif(price, '{CENSUS_MISSING}') AS DOUBLE) AS price,
           TRY_CAST(kind AS DOUBLE) AS lenient
    FROM marked
    WHERE kind <> '' AND (nullif(size, 'NA') IS NOT NULL OR nullif(price, '{CENSUS_MISSING}') IS NOT NULL)
    UNION ALL
    SELECT p_partkey, CAST(size AS DOUBLE), NULL, NULL FROM marked WHERE size <> 'NA'"""
)
def sentinel_clean(spark, sf):
    marked = _marked_parts(spark, sf)
    typed = drop_blank(marked, "kind").select(
        "p_partkey",
        null_if_sentinel(F.col("size"), "NA").alias("size"),
        null_if_sentinel(F.col("price"), CENSUS_MISSING).alias("price"),
        to_double(F.col("kind"), lenient=True).alias("lenient"),
    )
    nothing = F.lit(None).cast("double")
    known = drop_sentinel(marked, "size", "NA").select(
        "p_partkey", to_double(F.col("size")).alias("size"), nothing.alias("price"), nothing.alias("lenient")
    )
    return union_all([drop_all_null(typed, ["size", "price"]), known])


@query(
    f"""WITH marked AS (
      SELECT p_partkey, {_SIZE_MARK} AS size, {_PRICE_MARK} AS price,
             CASE WHEN p_type = 'PROMO' THEN '' ELSE p_type END AS kind FROM part)
    SELECT count(*) AS rows_in, count(*) FILTER (WHERE kind = '') AS dropped_blank_kind,
           count(*) FILTER (WHERE kind <> '' AND size = 'NA') AS dropped_no_size,
           count(*) FILTER (WHERE kind <> '' AND size <> 'NA' AND price = '{CENSUS_MISSING}') AS dropped_no_price,
           count(*) FILTER (WHERE kind <> '' AND size <> 'NA' AND price <> '{CENSUS_MISSING}') AS rows_kept,
           floor(CAST(count(*) FILTER (WHERE kind <> '' AND size <> 'NA' AND price <> '{CENSUS_MISSING}') AS DOUBLE)
             / count(*) * 100 * 10 + 0.5) / 10 AS percent_kept
    FROM marked"""
)
def row_loss(spark, sf):
    rules = {
        "blank_kind": F.col("kind") != "",
        "no_size": F.col("size") != "NA",
        "no_price": F.col("price") != CENSUS_MISSING,
    }
    return count_loss(_marked_parts(spark, sf), rules, floor_round)


@query(
    """WITH coded AS (
      SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'UNK' WHEN 'MACHINERY' THEN ''
             ELSE concat(CAST(c_custkey AS VARCHAR), '.0') END AS code FROM customer)
    SELECT c_custkey, CAST(CAST(TRY_CAST(code AS DOUBLE) AS BIGINT) AS VARCHAR) AS zip_code
    FROM coded WHERE code <> ''""",
    name="zip_from_float_text",
)
def zip_codes(spark, sf):
    coded = s.load(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "UNK")
        .when(F.col("c_mktsegment") == "MACHINERY", "")
        .otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit(".0")))
        .alias("code"),
    )
    return drop_blank(coded, "code").select("c_custkey", zip_from_float_text(F.col("code")).alias("zip_code"))


@query(
    """WITH labelled AS (
      SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN concat('Zip Code ', p_partkey)
                             ELSE concat('Zip Code: ', p_partkey) END AS label FROM part)
    SELECT p_partkey, string_split(label, ': ')[2] AS zip_code FROM labelled"""
)
def label_split(spark, sf):
    label = F.when(
        F.col("p_type") == "ECONOMY", F.concat(F.lit("Zip Code "), F.col("p_partkey").cast("string"))
    ).otherwise(F.concat(F.lit("Zip Code: "), F.col("p_partkey").cast("string")))
    return s.load(spark, sf, "part").select("p_partkey", area_from_label(label).alias("zip_code"))


@query(
    """WITH marked AS (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)
    SELECT event_id, ms, make_timestamp((ms // 1000) * 1000000) AS utc_seconds,
           timezone('America/Chicago', timezone('UTC', make_timestamp(ms * 1000))) AS local_time,
           CAST(year(timezone('America/Chicago', timezone('UTC', make_timestamp(ms * 1000)))) AS INTEGER) AS local_year
    FROM marked"""
)
def epoch_convert(spark, sf):
    marked = s.load(spark, sf, "events").select("event_id", to_epoch_ms(F.col("ts")).alias("ms"))
    local = from_epoch_ms_local(F.col("ms"), "America/Chicago")
    return marked.select(
        "event_id", "ms",
        from_epoch_ms_seconds(F.col("ms")).alias("utc_seconds"),
        local.alias("local_time"),
        year_of(local).alias("local_year"),
    )


@query(
    """SELECT 'segment' AS rule, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT 'range', count(*) FROM customer WHERE TRY_CAST(CAST(c_nationkey AS VARCHAR) AS INTEGER) BETWEEN 5 AND 12
    UNION ALL SELECT 'codes', count(*) FROM customer WHERE CAST(c_nationkey AS VARCHAR) IN ('1', '2', '24')
    UNION ALL SELECT 'flag', count(*) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'present', count(*) FROM customer WHERE nullif(c_mktsegment, 'HOUSEHOLD') IS NOT NULL"""
)
def code_filters(spark, sf):
    customer = s.load(spark, sf, "customer").withColumn("code", F.col("c_nationkey").cast("string"))
    orders = s.load(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("valid_sale")
    )
    segment = F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("segment")
    kept = {
        "segment": keep_state(customer, "c_mktsegment", "BUILDING"),
        "range": in_code_range(customer, "code", 5, 12),
        "codes": keep_codes(customer, "code", ["1", "2", "24"]),
        "flag": valid_sales(orders),
        "present": drop_null(customer.select(segment), ["segment"]),
    }
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n") for rule, df in kept.items()]
    )


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS permit_number, CAST(o_orderdate AS DATE) AS issued,
              CAST(year(o_orderdate) AS INTEGER) AS issued_year, concat(o_orderstatus, o_orderpriority) AS code,
              trim(concat(' ', o_orderpriority, ' ')) AS priority,
              coalesce(CAST(nullif(CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_custkey AS VARCHAR) END, '') AS BIGINT), 0) AS owner,
              'MORTGAGE30US' AS series_id, 2023 AS vintage_year
       FROM orders"""
)
def typed_projection(spark, sf):
    raw = s.load(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day_text"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_custkey").cast("string")).alias("owner"),
    )
    out = raw.select(
        code_text(F.col("o_orderkey")).alias("permit_number"),
        iso_date(F.col("day_text")).alias("issued"),
        year_of(iso_date(F.col("day_text"))).alias("issued_year"),
        concat_fips(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("code"),
        clean_code(F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" "))).alias("priority"),
        blank_as_zero(F.col("owner")).alias("owner"),
    )
    return stamp(out, series_id="MORTGAGE30US", vintage_year=2023)


@query(
    """SELECT DISTINCT zip_code FROM (
      SELECT s_nationkey AS zip_code FROM supplier UNION ALL SELECT c_nationkey FROM customer)"""
)
def union_distinct_areas(spark, sf):
    both = union_all(
        [
            s.load(spark, sf, "supplier").select(F.col("s_nationkey").alias("zip_code")),
            s.load(spark, sf, "customer").select(F.col("c_nationkey").alias("zip_code")),
        ]
    )
    return distinct_sorted(both, "zip_code")


@query(
    """SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n,
              count(*) FILTER (WHERE event_type = 'purchase') AS purchases
       FROM events GROUP BY 1"""
)
def json_props(spark, sf):
    events = s.load(spark, sf, "events").withColumn("k", F.from_json("props", "k int")["k"])
    return events.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "purchase").alias("purchases")
    )


@query(
    """SELECT time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS window_start,
              user_id AS zip_code, count(*) AS n
       FROM events GROUP BY 1, 2""",
    name="tumbling_counts",
)
def weekly_counts(spark, sf):
    """The batch twin of the streaming counts."""
    events = s.load(spark, sf, "events").select(
        F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("user_id").alias("zip_code")
    )
    return tumbling_counts(events, "ts", "zip_code", "7 days")


@query(
    """SELECT c_custkey AS source_name FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)"""
)
def seed_state_if_absent(spark, sf):
    """Customers whose number no supplier has; the suppliers stand for sources that have a state row."""
    known = s.load(spark, sf, "supplier").select(F.col("s_suppkey").alias("source_name"))
    return init_state(s.load(spark, sf, "customer").select(F.col("c_custkey").alias("source_name")), known)


@query(
    """WITH fetched AS (
      SELECT f, event_id, ts FROM events JOIN range(0, 10) r(f)
      ON date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) BETWEEN 3 * f - 5 AND 3 * f + 2),
    tops AS (SELECT f, date_trunc('second', max(ts)) AS top FROM fetched GROUP BY f),
    bounds AS (
      SELECT f, coalesce(lag(top) OVER (ORDER BY f) - INTERVAL 5 DAY, TIMESTAMP '2010-01-01') AS bound FROM tops),
    spoken AS (
      SELECT f, bound, min(bound) OVER (ORDER BY f ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM bounds)
    SELECT event_id, CAST(f AS VARCHAR) AS load FROM fetched JOIN spoken USING (f)
    WHERE ts >= bound AND (later IS NULL OR ts < later)"""
)
def overlapping_fetches(spark, sf):
    """Ten fetches of the events, each of its three days and the five before; every event is stored once, from the
    last fetch whose lookback covers it."""
    events = s.load(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    first, last = F.greatest(F.ceil((day - 2) / 3), F.lit(0)), F.least(F.floor((day + 5) / 3), F.lit(9))
    fetched = events.withColumn("load", F.explode(F.when(first <= last, F.sequence(first, last)).cast("array<string>")))
    tops = dict(fetched.groupBy("load").agg(F.max("ts")).collect())
    ranges, _ = fetch_ranges(sorted(tops), tops, None, (5, "2010-01-01T00:00:00"), TIME_FORMAT)
    return last_fetch_wins(fetched, ranges, "ts").select("event_id", "load")
