"""Scans of landed files, one function per payload layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from areascore.schemas import OBSERVATIONS, feature_page
from areascore.session import settle


def read_market_tsv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Tab-separated text with a header, plain or gzip, every column as text.

    Only the columns a query selects are parsed. A gzip file is one task, so spread its rows
    after the first filter when there are few files: ``spread(df)``. All files must have the same
    header, that of ``schema`` if it is given; one that differs fails the read instead of being mapped by position.
    """
    reader = spark.read.option("sep", "\t").option("header", True).option("enforceSchema", False)
    return (reader.schema(schema) if schema else reader).csv(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows evenly over the cluster, whatever their keys."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 1))


#: Column with the place of a row's release among those of its folder.
RELEASE = "_release"


def read_wide_csv(spark: SparkSession, path: str, required: Sequence[str] = ()) -> DataFrame:
    """Comma-separated releases with a header each, whose month columns vary; all text.

    Every file is read by its own header and columns are matched by name; a file without one of
    ``required`` fails the read. ``_release`` numbers the files in the order of their paths. The number of jobs doesn't
    depend on the number of files: one pass finds the header of each, its first line; then all files are one scan, and
    each row takes its values from the places that its file's header gives them.
    """
    heads = _headers(spark, path)
    n_files, width, size = heads.agg(F.count(F.lit(1)), F.max(F.size("header")), F.sum(F.length("line"))).head()
    if not n_files:
        raise ValueError(f"no file in {path}")
    lacking = F.filter(F.array(*map(F.lit, required)), lambda c: ~F.array_contains("header", c)) if required else F.array()
    bad = heads.select("file", lacking.alias("missing")).filter(F.size("missing") > 0).orderBy("file").head(1)
    if bad:
        raise ValueError(f"{bad[0]['file']} has no column {bad[0]['missing']}")
    found = heads.select("file", F.posexplode("header").alias("at", "name")).groupBy("name").agg(F.min_by("at", "file").alias("at"), F.min("file").alias("file"))
    names = [r["name"] for r in found.orderBy("file", "at").collect() if r["name"] is not None]  # the columns of the result
    release = F.array_position(heads.agg(F.sort_array(F.collect_list("file"))).scalar(), F.col("file")) - 1
    places = F.transform(F.array(*map(F.lit, names)), lambda n: (F.array_position("header", n) - 1).cast("int"))
    by_file = heads.select("file", "header", release.cast("int").alias(RELEASE), places.alias("_places"))
    if size <= HEADER_BYTES:
        by_file = F.broadcast(by_file)
    cells = [f"_c{i}" for i in range(width)]
    rows = spark.read.schema(", ".join(f"{c} string" for c in cells)).csv(path)
    rows = rows.select(F.array(*cells).alias("_row"), F.col("_metadata.file_path").alias("file"))
    met = rows.join(by_file, "file").filter(~F.slice("_row", F.lit(1), F.size("header")).eqNullSafe(F.col("header")))
    place = lambda i: F.col("_places")[i]
    return met.select(*(F.when(place(i) >= 0, F.get("_row", place(i))).alias(n) for i, n in enumerate(names)), RELEASE)


#: Bytes of all headers up to which they are broadcast.
HEADER_BYTES = 32 << 20


def _headers(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``line`` and ``header`` (its names) of each file: the line that comes first in the file's first block."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    first = lines.withColumn("nth", F.monotonically_increasing_id()).filter("block = 0").groupBy("file").agg(F.min_by("value", "nth").alias("line"))
    first = settle(first)
    width = first.agg(F.max(F.size(F.split("line", ",")))).head()[0] or 1  # quoted names may hold commas: a bound
    cells = [f"_c{i}" for i in range(width)]
    parsed = first.select("file", "line", F.from_csv("line", ", ".join(f"{c} string" for c in cells)).alias("_h"))
    header = F.array(*(F.col(f"_h.{c}") for c in cells))
    size = F.aggregate(F.sequence(F.lit(1), F.size("_cells")), F.lit(0), lambda a, i: F.when(F.get("_cells", i - 1).isNotNull(), i).otherwise(a))
    named = parsed.select("file", "line", header.alias("_cells"))
    return named.select("file", "line", F.slice("_cells", F.lit(1), size).alias("header"))


def read_header_matrix(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """JSON list of lists, first row the header; ``columns`` are picked by header name.

    One file is one response and stays one record until it is exploded. Partition folders in
    ``path`` (``vintage=2023``) become columns.
    """
    pages = spark.read.option("wholetext", True).text(path)
    folders = [c for c in pages.columns if c != "value"]
    rows = pages.select(*folders, F.from_json("value", "array<array<string>>").alias("m"))
    body = rows.filter(F.size("m") > 1).select(
        *folders,
        F.col("m")[0].alias("header"),
        F.explode(F.slice("m", F.lit(2), F.size("m") - 1)).alias("row"),
    )

    def pick(name: str):
        at = F.array_position("header", name)
        missing = F.raise_error(F.lit(f"no column {name!r} in header")).cast("string")
        return F.when(at == 0, missing).otherwise(F.get("row", (at - 1).cast("int"))).alias(name)

    return body.select(*(pick(c) for c in columns), *folders)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """JSON object with an ``observations`` array; an empty array gives no rows."""
    return (
        spark.read.schema(OBSERVATIONS)
        .option("multiLine", True)
        .json(path)
        .select(F.explode("observations").alias("o"))
        .select("o.date", "o.value")
    )


def read_pages(spark: SparkSession, path: str, attr_schema: StructType) -> DataFrame:
    """Pages as they landed: ``features`` and, on a refused request, ``error``."""
    return spark.read.schema(feature_page(attr_schema)).option("multiLine", True).json(path)


def unwrap_features(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("features").alias("f")).select("f.attributes.*")


def read_feature_pages(spark: SparkSession, path: str, attr_schema: StructType) -> DataFrame:
    """Attributes of all features of all pages. A page that carries an error fails the read."""
    pages = read_pages(spark, path, attr_schema)
    refused = F.raise_error(F.concat(F.lit("page carries an error: "), F.col("error")))
    checked = pages.withColumn(
        "features", F.when(F.col("error").isNull(), F.col("features")).otherwise(refused.cast(pages.schema["features"].dataType))
    )
    return unwrap_features(checked)


def assert_no_error_pages(pages: DataFrame) -> None:
    """Fail before anything is written if a landed page is an error body."""
    bad = pages.filter(F.col("error").isNotNull()).select("error").head(1)
    if bad:
        raise ValueError(f"page carries an error: {bad[0]['error']}")


def read_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Small list with a header; codes stay text. Its file size lets Spark broadcast it."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_relationship(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-delimited area-to-county file, all text."""
    return spark.read.option("sep", "|").option("header", True).csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Feature collection as (zcta, geometry); the shape is carried as text, never computed on."""
    schema = "features array<struct<properties:struct<ZCTA5:string>,geometry:string>>"
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .json(path)
        .select(F.explode("features").alias("f"))
        .select(F.col("f.properties.ZCTA5").alias("zcta"), F.col("f.geometry").alias("geometry"))
    )
