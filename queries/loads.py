"""Loads under the contract: given tables landed as files, loaded twice and read back; a stream run to its end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areascore.functions.fixed_values import LOOKBACK, STATE_CODE
from areascore.functions.times import to_epoch_ms
from areascore.plans import ingest
from areascore.session import shared_folder
from areascore.sources.tables import read_raw
from areascore.streaming.counts import run_counts
from queries import standins as s
from queries.registry import query

PAGE_ROWS = 2000


def _stored(spark: SparkSession, place: str, table: str) -> DataFrame:
    """A raw table without its load time."""
    return read_raw(spark, f"{place}/raw", table).drop("ingested_at")


# -- feature pages, replaced from a bound (K3, M4) ----------------------------------------------

#: Days between the ends of fetches, days that a fetch reaches back, and fetches. Time is stretched so that events span a year.
STRETCH, EVERY, REACH, FETCHES = 12, 100, 40, 4


def _land_pages(records: DataFrame, landing: str) -> None:
    """Records with ``load`` as pages of some PAGE_ROWS features, one file each."""
    sizes = records.groupBy("load").agg(F.ceil(F.count(F.lit(1)) / PAGE_ROWS).alias("_pages"))
    attributes = F.struct(*(c for c in records.columns if c != "load")).alias("attributes")
    page = F.pmod(F.xxhash64(*records.columns), F.col("_pages"))
    pages = records.join(sizes, "load").groupBy("load", page.alias("page")).agg(F.collect_list(F.struct(attributes)).alias("features"))
    pages.drop("page").write.partitionBy("load").option("maxRecordsPerFile", 1).mode("append").json(landing)


@query(
    f"""WITH stretched AS (
      SELECT event_id, user_id, CASE event_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in s.OFFENCES.items())} END AS incident_type,
        epoch_ms((epoch_us(TIMESTAMP '2024-01-01') // 1000 + (epoch_us(ts) // 1000 - epoch_us(TIMESTAMP '2024-01-01') // 1000) * {STRETCH})::BIGINT) AS t
      FROM events),
    timed AS (SELECT event_id, user_id, incident_type, t, epoch_ms((epoch_us(t) // 1000000 * 1000)::BIGINT) AS sec FROM stretched),
    fetched AS (
      SELECT f, t.* FROM timed t JOIN range(0, {FETCHES}) r(f)
      ON date_diff('day', DATE '2024-01-01', CAST(t AS DATE)) BETWEEN {EVERY} * f - {REACH} AND {EVERY} * (f + 1) - 1),
    tops AS (SELECT f, max(sec) AS top FROM fetched WHERE user_id % 50 <> 7 GROUP BY f),
    bounds AS (
      SELECT f, coalesce(lag(top) OVER (ORDER BY f) - INTERVAL {LOOKBACK["crime"][0]} DAY, TIMESTAMP '{LOOKBACK["crime"][1]}') AS bound FROM tops),
    spoken AS (
      SELECT f, bound, min(bound) OVER (ORDER BY f ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM bounds)
    SELECT sec AS incident_occurred, incident_type, CAST(37000 + user_id % 25 AS VARCHAR) AS zip_code
    FROM fetched JOIN spoken USING (f)
    WHERE user_id % 50 <> 7 AND sec >= bound AND (later IS NULL OR sec < later)"""
)
def incident_round_trip(spark, sf):
    """The events as pages of four fetches, each of its days and some before; two are loaded, then all, then nothing
    new. Areas that are no number are dropped, and every other event is stored from the last fetch that speaks for it."""
    place = shared_folder(spark, "incidents")
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    moved = to_epoch_ms(base) + (to_epoch_ms(F.col("ts").cast("timestamp_ntz")) - to_epoch_ms(base)) * STRETCH
    area = F.when(F.col("user_id") % 50 == 7, F.lit("UNK")).otherwise(F.concat(F.lit(37000) + F.col("user_id") % 25, F.lit(".0")))
    events = s.load(spark, sf, "events").select(
        moved.cast("double").alias("Incident_Occurred"), s.chosen("event_type", s.OFFENCES).alias("Offense_Description"), area.alias("ZIP_Code")
    )
    day = F.floor((F.col("Incident_Occurred") - to_epoch_ms(base)) / 86_400_000)
    first, last = F.greatest(F.floor(day / EVERY), F.lit(0)), F.least(F.floor((day + REACH) / EVERY), F.lit(FETCHES - 1))
    fetched = events.withColumn("load", F.explode(F.when(first <= last, F.sequence(first, last)).cast("array<string>")))
    _land_pages(fetched, f"{place}/land")
    args = f"{place}/land", f"{place}/raw", f"{place}/state"
    for part in (range(2), range(2, FETCHES)):
        for f in part:
            ingest.complete_fetch(spark, f"{place}/land", str(f))
        ingest.ingest_crime(spark, *args)
    if ingest.ingest_crime(spark, *args):
        raise RuntimeError("fetches were applied twice")
    return _stored(spark, place, "crime")


# -- market releases, replaced by key (K2, M2) ----------------------------------------------------

_MARKET = ["median_dom", "inventory", "avg_sale_to_list", "median_sale_price", "homes_sold", "new_listings"]


def _release(spark: SparkSession, sf: str) -> DataFrame:
    market = s.market(spark, sf).withColumn("bad", (F.col("inventory") % 97 == 13))
    text = {c.upper(): F.col(c).cast("string") for c in _MARKET}
    text["INVENTORY"] = F.when(F.col("bad"), "n/k").otherwise(F.col("inventory").cast("string"))
    label = F.concat(F.lit("Zip Code: "), F.col("zip_code").cast("string"))
    return market.select(
        label.alias("REGION"), F.lit(STATE_CODE).alias("STATE_CODE"), F.col("period_end").cast("string").alias("PERIOD_END"),
        *(c.alias(n) for n, c in text.items()), F.lit("NA").alias("MONTHS_OF_SUPPLY"),
    )


def _write_release(rows: DataFrame, place: str, name: str) -> None:
    rows.write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(f"{place}/land/release={name}")


_CUT = "1998-01-01", "2000-06-01", "2001-01-01"


@query(
    f"""WITH {s.market_sql().strip()},
    good AS (SELECT * FROM market WHERE inventory % 97 <> 13 OR inventory IS NULL),
    second AS (SELECT * REPLACE (median_sale_price + 1 AS median_sale_price) FROM good WHERE period_end >= DATE '{_CUT[0]}' AND period_end < DATE '{_CUT[2]}'),
    keys AS (SELECT DISTINCT zip_code, period_end FROM second),
    first AS (SELECT * FROM good WHERE period_end < DATE '{_CUT[1]}'),
    old AS (SELECT f.* FROM first f ANTI JOIN keys k ON f.zip_code = k.zip_code AND f.period_end = k.period_end),
    whole AS (SELECT * FROM old UNION ALL SELECT * FROM second
      UNION ALL SELECT * FROM good WHERE period_end > (SELECT max(period_end) FROM second))
    SELECT CAST(zip_code AS VARCHAR) AS zip_code, '{STATE_CODE}' AS state_code, period_end, median_dom, inventory, avg_sale_to_list,
      months_of_supply, median_sale_price, homes_sold, new_listings FROM whole"""
)
def market_round_trip(spark, sf):
    """Line items as market releases: two that overlap, where the second raises prices, are loaded together; then a third
    that holds everything, of which only later periods are new. Rows with an inventory that is no number are rejected."""
    place = shared_folder(spark, "market")
    rows, day = _release(spark, sf), F.col("PERIOD_END")
    raised = (F.col("MEDIAN_SALE_PRICE").cast("double") + 1).cast("string")
    _write_release(rows.filter(day < _CUT[1]), place, "1")
    _write_release(rows.filter((day >= _CUT[0]) & (day < _CUT[2])).withColumn("MEDIAN_SALE_PRICE", raised), place, "2")
    args = f"{place}/land", f"{place}/raw", f"{place}/state"
    ingest.ingest_market(spark, *args)
    _write_release(rows, place, "3")
    ingest.ingest_market(spark, *args)
    if ingest.ingest_market(spark, *args):
        raise RuntimeError("periods were loaded twice")
    return _stored(spark, place, "market")


@query(
    f"""WITH {s.market_sql().strip()}
    SELECT rule, CAST(n_rows AS BIGINT) AS n_rows FROM (
      SELECT count(*) AS rows_in, 0 AS dropped_no_area, 0 AS dropped_no_measure, 0 AS dropped_no_date, 0 AS dropped_bad_date,
        count(*) FILTER (WHERE inventory % 97 = 13) AS dropped_bad_number, count(*) FILTER (WHERE inventory % 97 <> 13 OR inventory IS NULL) AS rows_kept
      FROM market) UNPIVOT (n_rows FOR rule IN (rows_in, dropped_no_area, dropped_no_measure, dropped_no_date, dropped_bad_date, dropped_bad_number, rows_kept))
    UNION ALL SELECT 'rejected ' || inventory, count(*) FROM (SELECT 'n/k' AS inventory FROM market WHERE inventory % 97 = 13) GROUP BY 1"""
)
def market_losses(spark, sf):
    """What one release lost, by rule, and what its reject store holds; loading it again changes neither."""
    place = shared_folder(spark, "losses")
    _write_release(_release(spark, sf), place, "1")
    for _ in range(2):
        ingest.ingest_market(spark, f"{place}/land", f"{place}/raw", f"{place}/state")
    losses = ingest.read_losses(spark, f"{place}/raw").select("rule", "n_rows")
    rejects = ingest.read_rejects(spark, f"{place}/raw").groupBy(F.concat(F.lit("rejected "), F.col("INVENTORY")).alias("rule"))
    return losses.union(rejects.agg(F.count(F.lit(1)).alias("n_rows")))


# -- wide releases (S2, M1) -------------------------------------------------------------------------


def _wide(values: DataFrame, place: str, metric: str, name: str, months: list[str]) -> None:
    """One release: a row an area, a column a month."""
    cells = [F.max(F.when(F.col("month") == m, F.col("value"))).alias(m) for m in months]
    wide = values.groupBy("RegionName").agg(*cells).withColumns({"State": F.lit(STATE_CODE), "Metro": F.lit("m, n"), "CountyName": F.lit("c")})
    wide.coalesce(1).write.option("header", True).csv(f"{place}/land/{metric}/release={name}")


_WIDE_SQL = f"""WITH {s.HOME_VALUES.strip()},
    monthly AS (
      SELECT metric_type, CAST(zip_code AS VARCHAR) AS zip_code, last_day(period_month) AS month, max(value) AS value
      FROM home_values WHERE period_month >= DATE '1996-01-01' AND period_month < DATE '1997-01-01' GROUP BY 1, 2, 3)
    SELECT zip_code, '{STATE_CODE}' AS state, 'm, n' AS metro, 'c' AS county_name, month AS period_month, metric_type,
      CASE WHEN month >= DATE '1996-05-01' AND month < DATE '1996-09-01' THEN value + 1 ELSE value END AS value
    FROM monthly"""


@query(_WIDE_SQL)
def home_value_round_trip(spark, sf):
    """Orders as wide monthly files of three metrics: two releases whose months overlap, the second with higher values, are
    loaded together; a third brings the rest of the year and is loaded after them."""
    place = shared_folder(spark, "values")
    month = F.last_day("period_month")
    values = s.home_values(spark, sf).filter("period_month >= '1996-01-01' and period_month < '1997-01-01'")
    values = values.groupBy("metric_type", F.col("zip_code").cast("string").alias("RegionName"), month.cast("string").alias("month")).agg(F.max("value").alias("value"))
    months = ["1996-%02d-%02d" % (i + 1, d) for i, d in enumerate((31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31))]
    raised = values.withColumn("value", F.col("value") + 1)
    args = f"{place}/land", f"{place}/raw", f"{place}/state"
    own = {metric: (values.filter(F.col("metric_type") == metric), raised.filter(F.col("metric_type") == metric)) for metric in ("ZHVI", "ZORI", "ZHVF")}
    for metric, (plain, more) in own.items():
        _wide(plain, place, metric, "1", months[:6])
        _wide(more, place, metric, "2", months[4:8])
    ingest.ingest_home_values(spark, *args)
    for metric, (plain, _) in own.items():
        _wide(plain, place, metric, "3", months)
    ingest.ingest_home_values(spark, *args)
    return _stored(spark, place, "home_values")


# -- vintages (S4, M3) ------------------------------------------------------------------------------

@query(
    f"""WITH {s.CENSUS.strip()},
    years AS (SELECT unnest([2021, 2022, 2023]) AS y)
    SELECT CAST(37000 + zip_code AS VARCHAR) AS zcta, '47' AS state_fips, median_household_income, poverty_count,
      CASE WHEN zip_code % 7 <> 3 THEN total_population + y END AS total_population, CAST(y AS INTEGER) AS vintage_year
    FROM census, years"""
)
def vintage_round_trip(spark, sf):
    """Customers by nation as list-of-lists responses of three vintages, columns in another order each; two are loaded
    together, the third after them. Some areas have the mark of a missing number, and one lies outside the state."""
    place = shared_folder(spark, "vintages")
    people = s.census(spark, sf)
    args = f"{place}/land", f"{place}/raw", f"{place}/state"
    for year in (2021, 2022, 2023):
        total = F.when(F.col("zip_code") % 7 == 3, "-666666666").otherwise((F.col("total_population") + year).cast("string"))
        cells = {
            "NAME": F.lit("x"), "B19013_001E": F.col("median_household_income").cast("string"), "B17001_002E": F.col("poverty_count").cast("string"),
            "B01003_001E": total, "zip code tabulation area": (F.lit(37000) + F.col("zip_code")).cast("string"),
        }
        names = [*cells][year % 3 :] + [*cells][: year % 3]
        outside = F.array(*(F.lit("99999" if n.startswith("zip") else "1") for n in names))
        rows = people.agg(F.collect_list(F.array(*(cells[n] for n in names))).alias("r"))  # one row a nation
        matrix = F.concat(F.array(F.array(*map(F.lit, names)), outside), F.col("r"))
        rows.select(F.to_json(matrix)).write.text(f"{place}/land/zip/vintage={year}")
        if year > 2021:
            ingest.ingest_census(spark, *args)
    if ingest.ingest_census(spark, *args)["zip"]:
        raise RuntimeError("vintages were loaded twice")
    return _stored(spark, place, "census_zip")


# -- a stream (ST2) -----------------------------------------------------------------------------------

#: Runs that the events arrive in, days of a run, days a record may be late, and the days of a window.
RUNS, RUN_DAYS, LATE_DAYS, WINDOW_DAYS = 4, 8, 3, 2


def _arrives(day: Column, user: Column) -> Column:
    """The run that an event arrives in: that of its day, some of them one or two runs later."""
    late = F.when(user % 7 == 3, 1).when(user % 11 == 5, 2).otherwise(0)
    return F.least(F.floor(day / RUN_DAYS) + late, F.lit(RUNS - 1))


@query(
    f"""WITH e AS (
      SELECT ts, user_id, time_bucket(INTERVAL '{WINDOW_DAYS} days', ts, TIMESTAMP '1970-01-01') AS window_start,
        least(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // {RUN_DAYS}
              + CASE WHEN user_id % 7 = 3 THEN 1 WHEN user_id % 11 = 5 THEN 2 ELSE 0 END, {RUNS - 1}) AS run
      FROM events WHERE ts IS NOT NULL),
    tops AS (SELECT run, max(ts) AS top FROM e GROUP BY run),
    marks AS (SELECT run, max(top) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {LATE_DAYS} DAY AS mark FROM tops)
    SELECT window_start, user_id % 25 AS zip_code, count(*) AS n FROM e JOIN marks USING (run)
    WHERE mark IS NULL OR window_start + INTERVAL {WINDOW_DAYS} DAY > mark GROUP BY 1, 2"""
)
def stream_counts(spark, sf):
    """Counts of a stream that ran to its end: the events arrive in four runs, some late. Those whose window had closed
    when they came are dropped, all others are counted, and each window comes out once."""
    place = shared_folder(spark, "stream")
    events = s.load(spark, sf, "events").filter("ts is not null")
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    timed = events.select(F.col("ts").cast("timestamp_ntz").cast("timestamp").alias("ts"), (F.col("user_id") % 25).alias("zip_code"), _arrives(day, F.col("user_id")).alias("run"))
    end = spark.createDataFrame([("2100-01-01",)], "d string").select(F.col("d").cast("timestamp").alias("ts"), F.lit(-1).cast("long").alias("zip_code"))
    batches = [timed.filter(F.col("run") == i).drop("run") for i in range(RUNS)]
    for batch in [*batches, end]:  # the last closes all windows
        batch.write.mode("append").parquet(f"{place}/in")
        run_counts(spark, f"{place}/in", f"{place}/out", f"{place}/checkpoint", batch.schema, "ts", "zip_code", f"{LATE_DAYS} days", f"{WINDOW_DAYS} days")
    out = spark.read.parquet(f"{place}/out").filter("zip_code >= 0")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "zip_code", "n")
