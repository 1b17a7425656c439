"""Sinks and run state: append, range replacement, watermarks, audit, seeds, layers."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from areascore.functions.times import month_of
from areascore.operators.reshape import batch_time
from areascore.operators.windows import dedup
from areascore.schemas import AUDIT, RAW_TABLES, STATE
from areascore.session import settle

KEEP = object()  # set_state: leave this field as it is

# A raw table is a parquet folder partitioned by this column, taken from its time column, so
# that replacing a range rewrites only the months the range touches.
MONTH = "part_month"
# Below a month, the load that wrote it. What a table holds is what its newest manifest lists.
SNAPSHOT = "part_load"
MANIFESTS = "_manifests"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def ensure_table(spark: SparkSession, path: str, schema: StructType, partition: str | None = None) -> None:
    """Create the table as an empty parquet folder if it is not there."""
    if not path_exists(spark, path):
        writer = spark.createDataFrame([], schema).write
        (writer.partitionBy(partition) if partition else writer).parquet(path)


def ensure_raw_tables(spark: SparkSession, root: str) -> None:
    for name, schema in RAW_TABLES.items():
        if name not in RANGE_COLUMNS:  # a range table without a manifest is empty
            ensure_table(spark, f"{root}/{name}", schema)


# Time column that ranges are replaced by, per raw table.
RANGE_COLUMNS = {
    "home_values": "period_month",
    "market": "period_end",
    "crime": "incident_occurred",
    "permits": "date_issued",
    "rates": "observation_date",
    "property": "own_date",
    "census_zip": "vintage_year",
    "census_county": "vintage_year",
}


def partitioned_schema(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add(MONTH, "date")


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A raw table with its contract columns."""
    schema = RAW_TABLES[name]
    if name in RANGE_COLUMNS:
        return read_range_table(spark, f"{root}/{name}", schema).select(*schema.names)
    return spark.read.schema(schema).parquet(f"{root}/{name}").select(*schema.names)


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and a function that makes its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def read_manifest(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Number and month folders (``part_month=.../part_load=...``) of the newest manifest; (0, []) if there is none."""
    fs, make = _files(spark, path)
    folder = make(f"{path}/{MANIFESTS}")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    version = max((int(n) for n in names if n.isdigit()), default=0)
    if not version:
        return 0, []
    return version, _read_lines(spark, fs, make(f"{path}/{MANIFESTS}/{version:012d}"))


def write_manifest(spark: SparkSession, path: str, version: int, folders: list[str]) -> None:
    """Publish ``folders`` as the table's content in one step: a file is written aside and renamed. A second
    writer of the same version fails, since the name is taken."""
    fs, make = _files(spark, path)
    aside = make(f"{path}/{MANIFESTS}/.{version:012d}-{uuid.uuid4().hex}")
    _write_text(fs, aside, sorted(folders))
    if not fs.rename(aside, make(f"{path}/{MANIFESTS}/{version:012d}")):
        raise RuntimeError(f"version {version} of {path} was written by another job")


def _read_folders(spark: SparkSession, path: str, folders: list[str], schema: StructType) -> DataFrame:
    full = StructType([*partitioned_schema(schema).fields]).add(SNAPSHOT, "string")
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*(f"{path}/{f}" for f in folders))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; one that isn't there is fine."""
    fs, make = _files(spark, path)
    fs.delete(make(path), True)


def _write_text(fs, path, lines: list[str]) -> None:
    stream = fs.create(path)
    try:
        stream.write(bytearray("\n".join(lines) + "\n", "utf-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, lines: list[str]) -> None:
    """A small text file of its own."""
    fs, make = _files(spark, path)
    _write_text(fs, make(path), lines)


def _read_lines(spark: SparkSession, fs, path) -> list[str]:
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [line for line in text.split("\n") if line]


def read_range_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table as its newest manifest has it. A load that runs meanwhile writes other folders."""
    return _read_folders(spark, path, read_manifest(spark, path)[1], schema)


def append(df: DataFrame, path: str) -> int:
    """Append and return the number of rows, counted from what is appended; no rows write nothing."""
    df = settle(df)
    n = df.count()
    if n:
        df.write.mode("append").parquet(path)
    return n


def replace_keys(target: DataFrame, new: DataFrame, key: str, scope: str | None = None) -> DataFrame:
    """``target`` without the rows whose key occurs in ``new``, plus ``new``.

    With ``scope`` a row is replaced only when both columns match. Null keys replace nothing.
    """
    cols = [key, scope] if scope else [key]
    return target.join(new.select(*cols).dropna().distinct(), cols, "left_anti").select(*target.columns).unionByName(new)


def replace_from(target: DataFrame, new: DataFrame, ts_col: str, cutoff: str) -> DataFrame:
    """``target`` before the cutoff, plus ``new``. A null time is before nothing and is kept."""
    bound = F.lit(cutoff).cast(target.schema[ts_col].dataType)
    return target.filter(F.col(ts_col).isNull() | (F.col(ts_col) < bound)).unionByName(new)


class Written(NamedTuple):
    """Rows of a load and the highest value of its time column, both read from what was stored."""

    rows: int
    top: date | datetime | int | None


def _month_of(folder: str) -> str | None:
    """Month of a manifest line, None for rows without a time."""
    value = folder.split("/")[0].partition("=")[2]
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value


class _Load:
    """One load of a range table: rows go to folders of its own, and count once the manifest lists them.

    Nothing that readers see is changed or removed before that, so a crash at any point leaves the old
    table, and a rerun writes new folders. Folders that no manifest lists may be deleted at any time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path, schema
        self.name = uuid.uuid4().hex
        self.version, self.folders = read_manifest(spark, path)

    def write(self, df: DataFrame) -> None:
        """Rebalancing gathers small months and splits a hot one over several tasks and files."""
        marked = df.select(*self.schema.names, MONTH, F.lit(self.name).alias(SNAPSHOT))
        marked.hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH, SNAPSHOT).parquet(self.path)

    def own(self) -> list[str]:
        """The folders this load has written, from the listing of its months."""
        fs, make = _files(self.spark, self.path)
        found = fs.globStatus(make(f"{self.path}/{MONTH}=*/{SNAPSHOT}={self.name}"))
        return [f"{f.getPath().getParent().getName()}/{f.getPath().getName()}" for f in found or ()]

    def read(self, folders: list[str]) -> DataFrame:
        return _read_folders(self.spark, self.path, folders, self.schema).drop(SNAPSHOT)

    def publish(self, kept: list[str]) -> None:
        write_manifest(self.spark, self.path, self.version + 1, [*kept, *self.own()])


def _measured(df: DataFrame, col: str) -> Written:
    return Written(*df.agg(F.count(F.lit(1)), F.max(col)).head())


def write_replace_keys(
    spark: SparkSession, path: str, new: DataFrame, key: str, schema: StructType, scope: str | None = None
) -> Written:
    """Replace the rows whose ``key`` date occurs in ``new``; rows of ``new`` without a date are left out.

    The new rows are written once and measured from what was written. Only months that they touch are
    read, and their rows that stay are written beside the new ones.
    """
    load = _Load(spark, path, schema)
    dated = new.filter(F.col(key).isNotNull())
    load.write(dated.select(*schema.names).withColumn(MONTH, month_of(F.col(key))))
    own = load.own()
    fresh = load.read(own)
    measured = _measured(fresh, key)
    if measured.rows == 0:
        return measured
    months = {_month_of(f) for f in own}
    touched = [f for f in load.folders if _month_of(f) in months]
    if touched:
        cols = [key, scope] if scope else [key]
        load.write(load.read(touched).join(fresh.select(*cols).distinct(), cols, "left_anti"))
    load.publish([f for f in load.folders if f not in touched])
    return measured


def write_replace_partitions(spark: SparkSession, path: str, new: DataFrame, key: str, schema: StructType) -> Written:
    """Replace whole years, as for vintages, whose ``key`` is the year; nothing old is read.

    The years of ``new`` come into the table in one step, whatever their number: a crash leaves the old ones.
    """
    load = _Load(spark, path, schema)
    load.write(new.select(*schema.names).withColumn(MONTH, F.make_date(key, F.lit(1), F.lit(1))))
    own = load.own()
    measured = _measured(load.read(own), key)
    if measured.rows:
        years = {_month_of(f) for f in own}
        load.publish([f for f in load.folders if _month_of(f) not in years])
    return measured


def write_replace_from(
    spark: SparkSession, path: str, new: DataFrame, ts_col: str, cutoff: str, schema: StructType
) -> Written:
    """Replace everything at or after ``cutoff`` by ``new``, whose rows all lie there.

    Months before the cutoff, and rows without a time, are neither read nor written. Rows of the
    cutoff's own month that lie before it are written beside the new ones; later months are the new
    rows' alone. No new rows change nothing. A rerun with the same input gives the same table.
    """
    load = _Load(spark, path, schema)
    load.write(new.select(*schema.names).withColumn(MONTH, month_of(F.col(ts_col))))
    measured = _measured(load.read(load.own()), ts_col)
    if measured.rows == 0:
        return measured
    first = cutoff[:7] + "-01"
    split = [f for f in load.folders if _month_of(f) == first]
    if split:
        bound = F.lit(cutoff).cast(schema[ts_col].dataType)
        load.write(load.read(split).filter(F.col(ts_col) < bound))
    load.publish([f for f in load.folders if _month_of(f) is None or _month_of(f) < first])
    return measured


# Manifests that are kept whatever their age, files of a log up to which it isn't folded, and the seconds that a
# reader or a load may take: nothing is deleted that was in use that long ago.
KEPT_MANIFESTS, LOG_FILES, GRACE = 3, 64, 86_400.0


def _old(status, grace: float) -> bool:
    return status.getModificationTime() / 1000 <= time.time() - grace


def expire(spark: SparkSession, path: str, keep: int = KEPT_MANIFESTS, grace: float = GRACE) -> int:
    """Delete what no reader of a range table can need, and return the number of folders that went.

    Manifests go if ``keep`` newer ones exist and they are older than ``grace`` seconds; load folders go if no manifest that
    stays lists them and they are that old too, so that a load that is writing loses nothing. Storage is then
    bounded by the table, the kept versions and what ``grace`` seconds of loads wrote.
    """
    fs, make = _files(spark, path)
    folder = make(f"{path}/{MANIFESTS}")
    if not fs.exists(folder):
        return 0
    listed = fs.listStatus(folder)
    versions = sorted((f for f in listed if f.getPath().getName().isdigit()), key=lambda f: f.getPath().getName())
    gone = [f for f in versions[: max(0, len(versions) - keep)] if _old(f, grace)]
    stays = {line for f in versions if f not in gone for line in _read_lines(spark, fs, f.getPath())}
    for f in [*gone, *(f for f in listed if f.getPath().getName().startswith(".") and _old(f, grace))]:
        fs.delete(f.getPath(), False)
    n = 0
    for f in fs.globStatus(make(f"{path}/{MONTH}=*/{SNAPSHOT}=*")) or ():
        name = f"{f.getPath().getParent().getName()}/{f.getPath().getName()}"
        if name not in stays and _old(f, grace):
            fs.delete(f.getPath(), True)
            n += 1
    return n


def expire_children(spark: SparkSession, path: str, grace: float = GRACE) -> None:
    """Delete the folders below ``path`` that are older than ``grace`` seconds, as runs that broke off leave them."""
    fs, make = _files(spark, path)
    if fs.exists(make(path)):
        for f in fs.listStatus(make(path)):
            if _old(f, grace):
                fs.delete(f.getPath(), True)


def fold_log(
    spark: SparkSession, path: str, schema: StructType | str, keys: Sequence[str], order: str | None = None,
    most: int = LOG_FILES, grace: float = GRACE,
) -> bool:
    """Gather an append-only log of more than ``most`` files in one file with the newest row (by ``order``) of each of ``keys``.

    Rows stand twice for a while, which a reader of the newest rows doesn't notice. The files that were gathered are
    named in a list beside them and are deleted by a later call, ``grace`` seconds after, when no reader can have
    them open. A crash at any point leaves all rows readable.
    """
    fs, make = _files(spark, path)
    if not fs.exists(make(path)):
        return False
    aside, named = f"{path}/_folded", set()
    for f in fs.listStatus(make(aside)) if fs.exists(make(aside)) else ():
        names = _read_lines(spark, fs, f.getPath())
        if _old(f, grace):
            for name in names:
                fs.delete(make(f"{path}/{name}"), False)
            fs.delete(f.getPath(), False)
        else:
            named |= set(names)
    files = [f.getPath().getName() for f in fs.listStatus(make(path)) if f.isFile()]
    files = [f for f in files if not f.startswith(("_", ".")) and f not in named]
    if len(files) <= most:
        return False
    log = spark.read.schema(schema).parquet(*(f"{path}/{f}" for f in files))
    tie = [F.col(order).desc_nulls_last()] if order else [F.lit(0)]
    dedup(log, keys, tie).coalesce(1).write.mode("append").parquet(path)
    _write_text(fs, make(f"{aside}/{uuid.uuid4().hex}"), files)
    return True


def get_state(spark: SparkSession, path: str, source: str) -> tuple[str | None, str | None]:
    """(watermark, etag) of a source, ``(None, None)`` when it was never stored."""
    row = _state_row(spark, path, source)
    return (row["watermark_date"], row["last_etag"]) if row else (None, None)


def _state_row(spark: SparkSession, path: str, source: str):
    if not path_exists(spark, path):
        return None
    log = spark.read.schema(STATE).parquet(path).filter(F.col("source_name") == source)
    return next(iter(log.orderBy(F.col("version").desc()).head(1)), None)


def set_state(spark: SparkSession, path: str, source: str, watermark=KEEP, etag=KEEP, now: datetime | None = None) -> None:
    """Store state after the data was written. A field that is not given keeps its value.

    State is an append-only log that is folded now and then; the highest version of a source counts. A crash can leave
    the old state or the new one, never none.
    """
    old = _state_row(spark, path, source)
    stored = lambda field, value: (old[field] if old else None) if value is KEEP else value
    row = (
        source,
        stored("watermark_date", watermark),
        stored("last_etag", etag),
        now or batch_time(),
        (old["version"] if old else 0) + 1,
    )
    spark.createDataFrame([row], STATE).coalesce(1).write.mode("append").parquet(path)
    fold_log(spark, path, STATE, ["source_name"], "version")


def init_state(rows: DataFrame, existing: DataFrame, key: str = "source_name") -> DataFrame:
    """Seed rows whose key is not there yet."""
    return rows.join(existing.select(key).distinct(), key, "left_anti")


def write_init_state(spark: SparkSession, path: str, rows: list[tuple[str, str | None]]) -> int:
    seeds = spark.createDataFrame([(s, w, None, batch_time(), 0) for s, w in rows], STATE)
    ensure_table(spark, path, STATE)
    return append(init_state(seeds, spark.read.schema(STATE).parquet(path)).select(*STATE.names), path)


LAYERS = {"raw": "raw", "staging": "staging", "intermediate": "intermediate", "marts": "marts"}


def table_name(layer: str, name: str) -> str:
    """The layer is the database, with no prefix for the environment."""
    return f"{LAYERS[layer.strip()]}.{name}"


def publish(df: DataFrame, layer: str, name: str) -> DataFrame:
    """Staging models are views; later layers are tables, written once and read by the next."""
    spark = df.sparkSession
    if layer == "staging":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {LAYERS[layer]}")
    df.write.mode("overwrite").format("parquet").saveAsTable(table_name(layer, name))
    return spark.table(table_name(layer, name))


def write_seed(df: DataFrame, path: str) -> None:
    """CSV with a header; a list that fits one task comes out as one file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def append_audit(
    spark: SparkSession, path: str, job_name: str, status: str, run_id: str | None = None,
    now: datetime | None = None, notes: str | None = None, tests_run: int = 0, tests_passed: int = 0,
    **freshness: str,
) -> str:
    """Append one audit row; a missing run id and time get defaults."""
    unknown = {f"freshness_{name}" for name in freshness} - set(AUDIT.names)
    if unknown:
        raise ValueError(f"no audit columns {sorted(unknown)}")
    run_id = run_id or str(uuid.uuid4())
    values = {
        "run_id": run_id, "run_timestamp": now or batch_time(), "job_name": job_name, "status": status,
        "tests_run": tests_run, "tests_passed": tests_passed, "notes": notes,
        **{f"freshness_{name}": value for name, value in freshness.items()},
    }
    row = tuple(values.get(name) for name in AUDIT.names)
    spark.createDataFrame([row], AUDIT).coalesce(1).write.mode("append").parquet(path)
    return run_id
