"""Incremental loads: landed files to raw tables, one job per source.

Each job reads its state, parses the landed payload once into typed columns, keeps what is new,
replaces the affected range of the raw table and then moves the state. Running a job twice on
the same files gives the same table.

What is parsed is written as columns first, each row with the rule that drops it, if one does. Errors, newest
times, losses, rejected rows and the rows of the table are all read from there, so that text is parsed once and the
counts are those of what was stored.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from areascore.functions import fixed_values as fixed
from areascore.functions.numbers import null_if_sentinel, to_double
from areascore.functions.text import area_from_label, code_text, concat_fips, zip_from_float_text
from areascore.functions.times import from_epoch_ms_local, from_epoch_ms_seconds, iso_date, lookback_bound
from areascore.operators.aggregates import first_failed
from areascore.operators.filters import in_code_range, keep_codes, keep_state, newer_than, newer_versions
from areascore.operators.windows import dedup
from areascore.operators.reshape import stamp_ingested, unpivot_months
from areascore.plans.staging import MARKET_MEASURES
from areascore.schemas import CRIME_ATTRIBUTES, OBSERVATIONS, PERMIT_ATTRIBUTES, PROPERTY_ATTRIBUTES, RAW_TABLES, feature_page
from areascore.sources.files import (
    read_header_matrix,
    read_market_tsv,
    RELEASE,
    read_wide_csv,
    spread,
)
from areascore.sources.tables import (
    GRACE,
    KEEP,
    drop_folder,
    expire,
    expire_children,
    fold_log,
    get_state,
    path_exists,
    set_state,
    write_replace_from,
    write_replace_keys,
    write_replace_partitions,
    write_text,
)

WIDE_IDENTITY = ["RegionName", "State", "Metro", "CountyName"]
CENSUS_CODES = {
    "B19013_001E": "median_household_income",
    "B17001_002E": "poverty_count",
    "B01003_001E": "total_population",
}
TIME_FORMAT = "%Y-%m-%dT%H:%M:%S"
DAY_FORMAT = "%Y-%m-%d"


# -- staging of landed payloads ---------------------------------------------------------------


def stage_home_values(raw: DataFrame, metric: str, now: datetime | None = None) -> DataFrame:
    """Long rows of one metric in one state; of several releases the newest that has a value counts."""
    identity = [*WIDE_IDENTITY, *(c for c in (RELEASE,) if c in raw.columns)]
    long = unpivot_months(keep_state(raw, "State", fixed.STATE_CODE), identity, metric)
    if RELEASE in identity:
        long = dedup(long, ["RegionName", "period_month"], [F.col(RELEASE).desc()])
    return stamp_ingested(
        long.select(
            code_text(F.col("RegionName")).alias("zip_code"),
            F.col("State").alias("state"),
            F.col("Metro").alias("metro"),
            F.col("CountyName").alias("county_name"),
            "period_month",
            "value",
            "metric_type",
        ),
        now,
    )


#: Column with the first rule that drops a row; null if none does.
RULE = "_rule"


def _stage(raw: DataFrame, rules: Mapping[str, Column], columns: Mapping[str, Column], now: datetime | None) -> DataFrame:
    """The rows that pass all rules, typed."""
    kept = raw
    for keep in rules.values():
        kept = kept.filter(keep)
    return stamp_ingested(kept.select(*(c.alias(n) for n, c in columns.items()), *_fetch(raw)), now)


def _marked(raw: DataFrame, rule: Column, columns: Mapping[str, Column], carried: Sequence[str | Column], now: datetime | None) -> DataFrame:
    """All rows with the rule that drops them; only rows that no rule drops are typed, so that a bad value fails nothing."""
    typed = raw.withColumn(RULE, rule)
    return stamp_ingested(typed.select(*carried, RULE, *(F.when(F.col(RULE).isNull(), c).alias(n) for n, c in columns.items())), now)


def parse_market(raw: DataFrame) -> DataFrame:
    """Raw market rows with their area, day and numbers, null where they can't be read. Rules and columns both go by
    these, so that a text is parsed once."""
    numbers = {f"_{c}": F.nullif(F.col(c.upper()), F.lit(fixed.MARKET_MISSING)).try_cast("double") for c in MARKET_MEASURES}
    day = F.try_to_timestamp("PERIOD_END", F.lit("yyyy-MM-dd")).cast("date")
    return raw.withColumns({"_area": area_from_label(F.col("REGION")), "_day": day, **numbers})


def market_columns() -> dict[str, Column]:
    """Typed columns of parsed market rows."""
    return {"zip_code": F.col("_area"), "state_code": F.col("STATE_CODE"), "period_end": F.col("_day"), **{c: F.col(f"_{c}") for c in MARKET_MEASURES}}


def market_loss_rules() -> dict[str, Column]:
    """Rules that a parsed market row of the state must pass, in order."""
    some, numbers = F.lit(False), F.lit(True)
    for c in MARKET_MEASURES:
        present = F.coalesce(F.col(c.upper()) != fixed.MARKET_MISSING, F.lit(False))
        some = some | present
        numbers = numbers & (~present | F.col(f"_{c}").isNotNull())
    return {
        "no_area": F.col("_area").isNotNull(),
        "no_measure": some,
        "no_date": F.trim("PERIOD_END") != "",
        "bad_date": F.col("_day").isNotNull(),
        "bad_number": numbers,
    }


#: Rules that reject a row: it has content that can't be read, and goes to the reject store.
MARKET_REJECTS = ("bad_date", "bad_number")


def stage_market(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    """Typed market rows of one state; rows without an area, a date or any measure are dropped, and rows that can't be read."""
    return _stage(parse_market(keep_state(raw, "STATE_CODE", fixed.STATE_CODE)), market_loss_rules(), market_columns(), now)


def _census_measures() -> list:
    return [
        null_if_sentinel(F.col(code), fixed.CENSUS_MISSING).alias(name)
        for code, name in CENSUS_CODES.items()
    ]


def stage_census_zip(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    ranged = in_code_range(raw, "zip code tabulation area", *fixed.AREA_CODE_RANGE)
    return stamp_ingested(
        ranged.select(
            F.col("zip code tabulation area").alias("zcta"),
            F.lit(fixed.STATE_FIPS).alias("state_fips"),
            *_census_measures(),
            F.col("vintage").cast("int").alias("vintage_year"),
        ),
        now,
    )


def stage_census_county(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    whole = raw.withColumn("county_fips", concat_fips(F.col("state"), F.col("county")))
    return stamp_ingested(
        keep_codes(whole, "county_fips", list(fixed.COUNTIES)).select(
            "county_fips",
            F.col("NAME").alias("county_name"),
            F.col("state").alias("state_fips"),
            *_census_measures(),
            F.col("vintage").cast("int").alias("vintage_year"),
        ),
        now,
    )


def _fetch(raw: DataFrame) -> list[str]:
    """The name of the fetch goes along where rows have one."""
    return [c for c in ("load",) if c in raw.columns]


def crime_loss_rules() -> dict:
    """Rules a raw incident must pass, in order."""
    area = F.col("ZIP_Code")
    return {
        "blank_area": area.isNotNull() & (area != ""),
        "bad_area": zip_from_float_text(area).isNotNull(),
        "no_time": F.col("Incident_Occurred").isNotNull(),
    }


def crime_columns() -> dict[str, Column]:
    return {
        "incident_occurred": from_epoch_ms_seconds(F.col("Incident_Occurred")),
        "incident_type": F.col("Offense_Description"),
        "zip_code": zip_from_float_text(F.col("ZIP_Code")),
    }


def stage_crime(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    return _stage(raw, crime_loss_rules(), crime_columns(), now)


def permit_loss_rules() -> dict[str, Column]:
    return {"no_date": F.col("Date_Issued").isNotNull()}


def permit_columns() -> dict[str, Column]:
    return {
        "permit_number": F.col("Permit__"),
        "permit_type": F.col("Permit_Type_Description"),
        "date_issued": from_epoch_ms_local(F.col("Date_Issued"), fixed.PERMIT_ZONE),
        "zip_code": F.col("ZIP"),
        "construction_cost": to_double(F.col("Const_Cost"), lenient=True),
    }


def stage_permits(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    return _stage(raw, permit_loss_rules(), permit_columns(), now)


def rate_loss_rules() -> dict[str, Column]:
    return {"no_rate": F.col("value") != fixed.RATE_MISSING}


def rate_columns() -> dict[str, Column]:
    return {"observation_date": iso_date(F.col("date")), "rate": to_double(F.col("value")), "series_id": F.lit(fixed.RATE_SERIES)}


def stage_rates(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    return _stage(raw, rate_loss_rules(), rate_columns(), now)


def property_loss_rules() -> dict[str, Column]:
    """``stage_property`` needs a date; the load keeps valid sales only."""
    return {"no_date": F.col("OwnDate").isNotNull(), "not_valid": F.col("ValidSale") == "Y"}


def property_columns() -> dict[str, Column]:
    return {
        "apn": F.col("APN"),
        "prop_zip": code_text(F.col("PropZip")),
        "lu_code": code_text(F.col("LUCode")),
        "lu_desc": F.col("LUDesc"),
        "sale_price": to_double(F.col("SalePrice")),
        "own_date": from_epoch_ms_seconds(F.col("OwnDate")).cast("date"),
        "valid_sale": F.col("ValidSale"),
        "totl_appr": to_double(F.col("TotlAppr")),
        "totl_assd": to_double(F.col("TotlAssd")),
    }


def stage_property(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    rules = property_loss_rules()
    return _stage(raw, {"no_date": rules["no_date"]}, property_columns(), now)


# -- jobs -------------------------------------------------------------------------------------


def ingest_home_values(spark: SparkSession, landing_dir: str, table_dir: str, state: str) -> int:
    """Wide monthly files, one folder per metric. Each metric has its own watermark, so a metric
    that lags is not skipped, and replaces only its own rows of a period."""
    written = 0
    for metric in fixed.VALUE_METRICS:
        folder = f"{landing_dir}/{metric}"
        if not path_exists(spark, folder):
            continue
        source = f"home_values/{metric}"
        watermark, _ = get_state(spark, state, source)
        new = newer_than(stage_home_values(read_wide_csv(spark, folder, WIDE_IDENTITY), metric), "period_month", watermark)
        done = write_replace_keys(
            spark, f"{table_dir}/home_values", new, "period_month", RAW_TABLES["home_values"], "metric_type"
        )
        if done.rows:
            set_state(spark, state, source, done.top.strftime(DAY_FORMAT))
        written += done.rows
    return written


def landed(df: DataFrame, table_dir: str, source: str) -> tuple[DataFrame, str]:
    """``df`` written once as columns below ``_landed`` and read from there, and the folder, which goes when the load is done."""
    spark = df.sparkSession
    folder = f"{table_dir}/_landed/{source}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


#: Columns of the losses: what was loaded (a fetch or a release), the rule and the rows it dropped; ``rows_in`` and ``rows_kept``.
LOSSES = "rule string, n_rows bigint, ingested_at timestamp_ntz, source string, load string"


def loss_counts(rules: Sequence[str]) -> list[Column]:
    """Aggregates over landed rows: rows in, rows dropped by each rule, rows kept. Rows that stand for a page aren't counted."""
    own = [F.count_if(F.col(RULE).isNull() | ~F.col(RULE).isin(ERROR, EMPTY)).alias("rows_in")]
    return [*own, *(F.count_if(F.col(RULE) == r).alias(f"dropped_{r}") for r in rules), F.count_if(F.col(RULE).isNull()).alias("rows_kept")]


def record_losses(spark: SparkSession, table_dir: str, source: str, counts: Mapping[str, Mapping[str, int]], now: datetime | None = None) -> None:
    """Store the counts of each fetch or release in place of those it had, so that a load that is repeated counts once."""
    rows = [(rule, n, source, load) for load, own in counts.items() for rule, n in own.items()]
    df = stamp_ingested(spark.createDataFrame(rows, "rule string, n_rows bigint, source string, load string"), now)
    writer = df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("source", "load").parquet(f"{table_dir}/_losses")


def read_losses(spark: SparkSession, table_dir: str) -> DataFrame:
    return spark.read.schema(LOSSES).parquet(f"{table_dir}/_losses")


def read_rejects(spark: SparkSession, table_dir: str, source: str = "market") -> DataFrame:
    """The rows of a feed that couldn't be read, as they came, with ``rule``, ``load`` (their file) and ``ingested_at``."""
    raw = ", ".join(f"{c} string" for c in _market_raw())
    return spark.read.schema(f"rule string, {raw}, ingested_at timestamp_ntz, load string").parquet(f"{table_dir}/_rejects/{source}")


def _market_raw() -> list[str]:
    return ["REGION", "STATE_CODE", "PERIOD_END", *(c.upper() for c in MARKET_MEASURES)]


def newest_release(df: DataFrame, keys: Sequence[str], release: str = "load") -> DataFrame:
    """Of rows with equal ``keys``, those of the release whose name sorts last, all of them."""
    newest = df.groupBy(*keys).agg(F.max(release).alias("_newest"))
    return df.join(newest, [*keys]).filter(F.col(release) == F.col("_newest")).drop("_newest")


def ingest_market(spark: SparkSession, landing_dir: str, table_dir: str, state: str, etag=KEEP) -> int:
    """Gzip tab-separated market releases. ``etag`` is stored even when no period is new.

    A release is a file, or a folder ``release=<name>`` of files. One whose files are those of its last load holds no period
    after the watermark, and its losses and rejects are stored, so it isn't read again. Of several that hold a period of an
    area the one whose name sorts last counts. Rows whose date or number can't be read go to ``_rejects/market`` with their rule and file, rows without an area, date or measure are
    dropped; both are counted by file in ``_losses``.
    """
    watermark, _ = get_state(spark, state, "market")
    log = f"{table_dir}/_read/market"
    changed, old = changed_releases(spark, list_files(spark, landing_dir), log, watermark)
    if old and not changed:
        set_state(spark, state, "market", KEEP, etag)
        return 0
    paths = [_literal(p) for r in changed for p in r["paths"]] if old else landing_dir
    header = read_market_tsv(spark, _literal(old)).schema if old else None  # new files must have the header of those before
    listed = read_market_tsv(spark, paths, header).select(*_market_raw(), _release_name("_metadata.file_path", F.col("_metadata.file_name")).alias("load"))
    one_state = keep_state(listed, "STATE_CODE", fixed.STATE_CODE)
    if not fill_tasks(spark, paths):
        one_state = spread(one_state)
    rules = market_loss_rules()
    rejected = F.col(RULE).isin(*MARKET_REJECTS)
    kept_raw = F.when(rejected, F.struct(*_market_raw())).alias("_raw")
    marked = _marked(parse_market(one_state), first_failed(rules), market_columns(), ["load", kept_raw], None)
    rows, folder = landed(marked, table_dir, "market")
    found = {r["load"]: r.asDict() for r in rows.groupBy("load").agg(*loss_counts([*rules])).collect()}  # one row a file
    for own in found.values():
        own.pop("load")
    record_losses(spark, table_dir, "market", found)
    _write_rejects(rows.filter(rejected), f"{table_dir}/_rejects/market", found)
    kept = newer_than(rows.filter(F.col(RULE).isNull()).drop(RULE, "_raw"), "period_end", watermark)
    new = newest_release(kept, ["zip_code", "period_end"])
    done = write_replace_keys(spark, f"{table_dir}/market", new, "period_end", RAW_TABLES["market"])
    set_state(spark, state, "market", done.top.strftime(DAY_FORMAT) if done.rows else KEEP, etag)
    _note_releases(spark, log, changed, get_state(spark, state, "market")[0])
    drop_folder(spark, folder)
    maintain(spark, table_dir, "market")
    return done.rows


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path``, ``length`` and ``modificationTime`` of the files below ``path``, from their listing; none is opened."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")


def fill_tasks(spark: SparkSession, path: str | Sequence[str]) -> bool:
    """Whether the files below ``path`` keep all tasks busy as they are: none holds over twice a task's even part of the bytes."""
    largest, size = list_files(spark, path).agg(F.max("length"), F.sum("length")).head()
    return bool(size) and largest * spark.sparkContext.defaultParallelism <= 2 * size


def _literal(path: str) -> str:
    """A path that stands for itself and not for a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _release_name(path: str, file: Column) -> Column:
    """Name of the release a file belongs to: its folder ``release=<name>``, or the file's own name."""
    return F.coalesce(F.nullif(F.regexp_extract(path, "/release=([^/]+)/", 1), F.lit("")), file)


#: Log of loaded releases: a digest of their files (path, length, time of change), the watermark after, and the load's place in time.
READ = "load string, files string, watermark string, at bigint"


def changed_releases(spark: SparkSession, files: DataFrame, log: str, watermark: str | None) -> tuple[list, str | None]:
    """The releases (``load``, ``files``, ``paths``) whose files aren't those of their last load, and the largest file of the
    others. What was loaded up to a later watermark than the state's counts as never loaded."""
    each = F.concat_ws("|", "path", "length", F.unix_micros("modificationTime"))
    name = _release_name("path", F.substring_index("path", "/", -1))
    found = files.groupBy(name.alias("load")).agg(
        F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(each))), 256).alias("files"), F.collect_list("path").alias("paths"),
        F.max(F.struct("length", "path")).alias("largest"),
    )
    if not path_exists(spark, log):
        return found.orderBy("load").collect(), None
    last = dedup(spark.read.schema(READ).parquet(log), ["load"], [F.col("at").desc()])
    known = last.filter(F.col("watermark").isNull() | (F.col("watermark") <= F.lit(watermark))).select("load", "files")
    old = found.join(known, ["load", "files"], "left_semi").agg(F.max("largest")["path"]).head()[0]
    return found.join(known, ["load", "files"], "left_anti").orderBy("load").collect(), old


def _note_releases(spark: SparkSession, log: str, releases: Sequence, watermark: str | None) -> None:
    rows = [(r["load"], r["files"], watermark, time.time_ns()) for r in releases]
    spark.createDataFrame(rows, READ).coalesce(1).write.mode("append").parquet(log)
    fold_log(spark, log, READ, ["load"], "at")


def _write_rejects(rejects: DataFrame, path: str, found: Mapping[str, Mapping[str, int]]) -> None:
    """Rejected rows by file, in place of those the file had."""
    for load, counts in found.items():
        if not any(counts[f"dropped_{r}"] for r in MARKET_REJECTS):
            drop_folder(rejects.sparkSession, f"{path}/load={load}")
    out = rejects.select(F.col(RULE).alias("rule"), "_raw.*", "ingested_at", "load")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(path)


def maintain(spark: SparkSession, table_dir: str, source: str, grace: float = GRACE) -> None:
    """Keep what a source's loads leave behind bounded: old versions of its table, its log of fetches, and landed rows of
    loads that broke off."""
    expire(spark, f"{table_dir}/{source}", grace=grace)
    fold_log(spark, f"{table_dir}/_applied/{source}", "load string", ["load"], grace=grace)
    expire_children(spark, f"{table_dir}/_landed/{source}", grace)


def ingest_census(spark: SparkSession, landing_dir: str, table_dir: str, state: str) -> dict[str, int]:
    """List-of-lists responses under ``zip/vintage=YYYY`` and ``county/vintage=YYYY``. Each part has
    its own watermark, its last loaded vintage, so a part that lands late is not skipped."""
    layouts = {
        "zip": ("census_zip", stage_census_zip, [*CENSUS_CODES, "zip code tabulation area"]),
        "county": ("census_county", stage_census_county, ["NAME", *CENSUS_CODES, "state", "county"]),
    }
    counts = {}
    for part, (table, stage, columns) in layouts.items():
        counts[part] = 0
        folder = f"{landing_dir}/{part}"
        if not path_exists(spark, folder):
            continue
        source = f"census/{part}"
        watermark, _ = get_state(spark, state, source)
        new = stage(newer_versions(read_header_matrix(spark, folder, columns), "vintage", watermark))
        done = write_replace_partitions(spark, f"{table_dir}/{table}", new, "vintage_year", RAW_TABLES[table])
        counts[part] = done.rows
        if done.rows:
            set_state(spark, state, source, str(done.top))
        expire(spark, f"{table_dir}/{table}")
    return counts


# A fetch is a folder ``load=<name>`` of the landing folder with its pages; it counts once it holds this
# file, which states the number of its pages. Names sort in the order of the fetches.
COMPLETE = "complete"


def complete_fetches(markers: DataFrame) -> DataFrame:
    """``load`` and ``pages`` of the fetches whose marker is among ``markers`` (``value``, ``load``)."""
    return markers.filter("load is not null").groupBy("load").agg(F.max(F.trim("value").cast("int")).alias("pages"))


def read_markers(spark: SparkSession, landing_dir: str) -> DataFrame:
    schema = StructType([StructField("value", StringType()), StructField("load", StringType())])
    return spark.read.schema(schema).option("pathGlobFilter", COMPLETE).option("basePath", landing_dir).text(landing_dir)


def new_fetches(given: DataFrame, log: str) -> list[tuple[str, int | None]]:
    """(name, pages) of the fetches that weren't applied yet, in order. Spark takes those of the log out, so that what comes
    to the driver are the fetches since the last run, whatever was loaded before."""
    spark = given.sparkSession
    if path_exists(spark, log):
        given = given.join(spark.read.schema("load string").parquet(log), "load", "left_anti")
    return [(r["load"], r["pages"]) for r in given.orderBy("load").collect()]


def fetch_ranges(
    names: Sequence[str], tops: dict, watermark: str | None, lookback: tuple[int, str], pattern: str
) -> tuple[list[tuple[str, str, str | None]], str | None]:
    """(fetch, first time it replaces, first time a later one replaces) of the fetches that have something new, and the
    watermark after the last. ``tops`` has the newest time of each fetch; one that ends before its bound
    changes nothing."""
    bounds: list[tuple[str, str]] = []
    for name in names:
        bound, top = lookback_bound(watermark, *lookback), tops.get(name)
        if top is not None and top.strftime(TIME_FORMAT) >= bound:
            bounds.append((name, bound))
            watermark = top.strftime(pattern)
    ranges: list[tuple[str, str, str | None]] = []
    until = None
    for name, bound in reversed(bounds):
        ranges.append((name, bound, until))
        until = bound if until is None else min(until, bound)
    return ranges, watermark


def last_fetch_wins(staged: DataFrame, ranges: list[tuple[str, str, str | None]], ts_col: str) -> DataFrame:
    """Rows of ``staged`` (with ``load``) that lie in the part of time where their fetch is the last to speak."""
    kind = staged.schema[ts_col].dataType
    table = staged.sparkSession.createDataFrame(ranges, "load string, _from string, _until string").withColumns(
        {"_from": F.col("_from").cast(kind), "_until": F.col("_until").cast(kind)}
    )
    return staged.join(table, "load").filter(
        (F.col(ts_col) >= F.col("_from")) & (F.col("_until").isNull() | (F.col(ts_col) < F.col("_until")))
    )


#: Rules of rows that stand for a page and not for a record: it carries an error, or has none.
ERROR, EMPTY = "_error", "_empty"


class Feed(NamedTuple):
    """How the pages of a source are read, what drops their records, what columns they give, and the time that ranges go by."""

    read: Callable[[SparkSession, Sequence[str], str], DataFrame]
    rules: Callable[[], dict[str, Column]]
    columns: Callable[[], dict[str, Column]]
    time: str
    pattern: str


def load_fetches(
    spark: SparkSession, source: str, feed: Feed, landing_dir: str, table_dir: str, state: str, fetches: DataFrame | None = None
) -> int:
    """Apply the complete fetches that weren't applied yet as if one after the other, in one plan.

    The pages are parsed once, into typed columns that are written aside (``landed``); all that follows reads those. One
    aggregate over them finds pages that carry an error, the newest time of each fetch and what its rules dropped.
    A fetch replaces everything from its lookback bound, which depends on the newest time of the fetch before
    it. A row then counts if it lies from its own
    fetch's bound on and before the bounds of all later ones. So the number of jobs doesn't grow with the number
    of fetches, and only the folders of the new ones are read. The log of applied fetches is written last: a run
    that is repeated after a crash replaces the same range by the same rows, and the losses of a fetch by the same counts.
    """
    log = f"{table_dir}/_applied/{source}"
    new = new_fetches(complete_fetches(read_markers(spark, landing_dir)) if fetches is None else fetches, log)
    if not new:
        return 0
    names = [name for name, _ in new]
    folders = [f"{landing_dir}/load={name}" for name in names]
    counted = count_pages(spark, folders)
    for name, expected in new:
        if expected is not None and counted.get(name, 0) != expected:
            raise ValueError(f"fetch {name} has {counted.get(name, 0)} of {expected} pages")
    raw, rules = feed.read(spark, folders, landing_dir), feed.rules()
    rule = F.when(F.col(ERROR).isNotNull(), ERROR).when(F.col(EMPTY), EMPTY).otherwise(first_failed(rules))
    rows, folder = landed(_marked(raw, rule, feed.columns(), ["load", ERROR], None), table_dir, source)
    summary = rows.groupBy("load").agg(*loss_counts([*rules]), F.max(feed.time).alias("_top"), F.max(ERROR).alias("_bad"))
    tops, losses = {}, {name: {"rows_in": 0, **{f"dropped_{r}": 0 for r in rules}, "rows_kept": 0} for name in names}
    for r in summary.collect():  # one row a new fetch
        if r["_bad"] is not None:
            drop_folder(spark, folder)
            raise ValueError(f"page carries an error: {r['_bad']}")
        tops[r["load"]] = r["_top"]
        losses[r["load"]] = {k: r[k] for k in losses[r["load"]]}
    watermark, _ = get_state(spark, state, source)
    ranges, watermark = fetch_ranges(names, tops, watermark, fixed.LOOKBACK[source], feed.pattern)
    written = 0
    if ranges:
        kept = last_fetch_wins(rows.filter(F.col(RULE).isNull()).drop(RULE, ERROR), ranges, feed.time)
        lowest = min(bound for _, bound, _ in ranges)
        written = write_replace_from(spark, f"{table_dir}/{source}", kept, feed.time, lowest, RAW_TABLES[source]).rows
        set_state(spark, state, source, watermark)
    record_losses(spark, table_dir, source, losses)
    spark.createDataFrame([(n,) for n in names], "load string").coalesce(1).write.mode("append").parquet(log)
    drop_folder(spark, folder)
    maintain(spark, table_dir, source)
    return written


def _read_json(spark: SparkSession, folders: Sequence[str], base: str, page: StructType) -> DataFrame:
    schema = StructType([*page.fields]).add("load", StringType())
    return spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*.json").option("basePath", base).json([*folders])


def complete_fetch(spark: SparkSession, landing_dir: str, name: str) -> int:
    """Mark a landed fetch as complete, with the number of its pages, which is returned."""
    pages = count_pages(spark, [f"{landing_dir}/load={name}"]).get(name, 0)
    write_text(spark, f"{landing_dir}/load={name}/{COMPLETE}", [str(pages)])
    return pages


def count_pages(spark: SparkSession, folders: Sequence[str]) -> dict[str, int]:
    """Pages that each fetch has, from the listing of its folder; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load([*folders]).select("path")
    return dict(files.groupBy(F.regexp_extract("path", "load=([^/]+)/", 1)).count().collect())


def _fetched_pages(attributes: StructType):
    """Reads the pages of fetches as attributes with ``load``. A page that carries an error, and one without records, is
    one row that says so."""

    def read(spark: SparkSession, folders: Sequence[str], base: str) -> DataFrame:
        pages = _read_json(spark, folders, base, feature_page(attributes))
        each = pages.select("load", F.col("error").alias(ERROR), F.explode_outer("features").alias("f"))
        return each.select("load", ERROR, F.col("f").isNull().alias(EMPTY), "f.attributes.*")

    return read


def _fetched_observations(spark: SparkSession, folders: Sequence[str], base: str) -> DataFrame:
    pages = _read_json(spark, folders, base, OBSERVATIONS)
    each = pages.select("load", F.lit(None).cast("string").alias(ERROR), F.explode_outer("observations").alias("o"))
    return each.select("load", ERROR, F.col("o").isNull().alias(EMPTY), "o.date", "o.value")


FEEDS = {
    "crime": Feed(_fetched_pages(CRIME_ATTRIBUTES), crime_loss_rules, crime_columns, "incident_occurred", TIME_FORMAT),
    "permits": Feed(_fetched_pages(PERMIT_ATTRIBUTES), permit_loss_rules, permit_columns, "date_issued", TIME_FORMAT),
    "rates": Feed(_fetched_observations, rate_loss_rules, rate_columns, "observation_date", DAY_FORMAT),
    "property": Feed(_fetched_pages(PROPERTY_ATTRIBUTES), property_loss_rules, property_columns, "own_date", DAY_FORMAT),
}


def ingest_feed(
    spark: SparkSession, source: str, landing_dir: str, table_dir: str, state: str, fetches: DataFrame | Sequence[tuple[str, int | None]] | None = None
) -> int:
    """``fetches`` (``load``, ``pages``; null pages aren't checked) limits the load to some; those applied before are passed over."""
    if fetches is not None and not isinstance(fetches, DataFrame):
        fetches = spark.createDataFrame([*fetches], "load string, pages int")
    return load_fetches(spark, source, FEEDS[source], landing_dir, table_dir, state, fetches)


def ingest_crime(spark: SparkSession, landing_dir: str, table_dir: str, state: str) -> int:
    return ingest_feed(spark, "crime", landing_dir, table_dir, state)


def ingest_permits(spark: SparkSession, landing_dir: str, table_dir: str, state: str) -> int:
    return ingest_feed(spark, "permits", landing_dir, table_dir, state)


def ingest_rates(spark: SparkSession, landing_dir: str, table_dir: str, state: str) -> int:
    return ingest_feed(spark, "rates", landing_dir, table_dir, state)


def ingest_property(spark: SparkSession, landing_dir: str, table_dir: str, state: str) -> int:
    return ingest_feed(spark, "property", landing_dir, table_dir, state)
