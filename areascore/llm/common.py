"""Helpers that several operators share: word counts, running totals, blocks of a bucket, components."""

from __future__ import annotations

from collections.abc import Sequence

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from areascore.session import ensure_checkpoint_dir
from areascore.sources.tables import drop_folder

#: A word is a run of anything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder; for small or already reduced rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet to a new shared folder and read from there, and the folder."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """As ``written``; for rows as large as the input that are read until the end."""
    return written(df, name)[0]


def n_words(text: Column) -> Column:
    """Number of words of ``text``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def running(
    df: DataFrame, order: Sequence[Column], values: dict[str, Column], group: str | None = None
) -> DataFrame:
    """``df`` with, for each of ``values``, ``<name>_before`` (sum over the earlier rows) and
    ``<name>_total`` (sum over all rows), and ``row_before`` (number of earlier rows).

    ``order`` is the global order; ``group`` names a column without nulls that ``order`` starts with, and
    sums then start anew with each of its values. Rows are dealt into ranges of the order and written
    once; each range's totals give the offset of the next, so no task sees more than one range and a
    group that holds most rows spreads over many. Ranges are cut by sampling, sums don't depend on it.
    Clashing column names are the caller's to avoid; names that start with ``_`` are used inside.
    """
    keys = [group] if group else []
    named = {"row": F.lit(1).cast("long"), **values}
    dealt = df.select("*", *(c.alias(f"_v_{n}") for n, c in named.items()), *(c.alias(f"_o_{i}") for i, c in enumerate(order)))
    by = [F.col(f"_o_{i}") for i in range(len(order))]
    dealt = settled(dealt.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()))
    each = dealt.groupBy("_part", *keys).agg(*(F.sum(f"_v_{n}").alias(f"_s_{n}") for n in named))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = each.select(
        "_part", *keys,
        *(F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in named),
        *(F.sum(f"_s_{n}").over(whole).alias(f"{n}_total") for n in values),
    )
    inside = Window.partitionBy("_part", *keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.select("*", *(F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)).alias(f"_i_{n}") for n in named))
    rows = rows.join(offsets, ["_part", *keys])
    kept = [c for c in df.columns]
    return rows.select(
        *kept,
        *((F.col(f"_b_{n}") + F.col(f"_i_{n}")).alias(f"{n}_before") for n in named),
        *(f"{n}_total" for n in values),
    )


def blocks(entries: DataFrame, key: Sequence[str], member: str, block: int) -> DataFrame:
    """Rows of ``entries`` that share ``key`` with another row, dealt into comparisons of bounded size.

    A key with up to ``block`` rows is one comparison. A larger one is cut into m parts by a hash of
    ``member``, and each pair of parts is one comparison (``_i``, ``_j``), so each two rows meet in at least one
    and no task holds more than two parts. Sorted by key and comparison inside each partition.
    """
    sizes = entries.groupBy(*key).agg(F.count("*").alias("_n")).filter("_n > 1")
    rows = entries.join(sizes, list(key)).withColumn("_m", F.ceil(F.col("_n") / block).cast("int"))
    own = F.pmod(F.xxhash64(member), F.col("_m")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_m") - 1),
        lambda x: F.struct(F.least(x, F.col("_own")).alias("_i"), F.greatest(x, F.col("_own")).alias("_j")),
    )
    rows = rows.withColumn("_own", own).withColumn("_at", F.explode(pairs))
    rows = rows.select("*", F.col("_at._i").alias("_i"), F.col("_at._j").alias("_j")).drop("_at", "_n", "_m")
    by = [*key, "_i", "_j"]
    return rows.repartition(*by).sortWithinPartitions(*by, member)


def same_runs(*columns: np.ndarray) -> np.ndarray:
    """Start of each run of equal rows, and the end of the last; for at least one row."""
    change = np.zeros(len(columns[0]) - 1, dtype=bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [len(columns[0])]])


def smallest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n-1 with links a-b, the smallest node that each can reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def components(links: DataFrame) -> DataFrame:
    """For links ``a``, ``b`` (long, in any direction, repeats allowed): ``node`` and ``root``, its smallest
    reachable node. Only nodes that have links come back.

    Two steps alternate until nothing changes: every node hands its larger neighbours to its smallest one,
    then its smaller ones. Each round is written to the shared folder, and the one before it is deleted then.
    """
    spark = links.sparkSession
    now, folder = written(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")
        ).select("x.a", "x.b").filter("a <> b").distinct()
        old = folder
        now, folder = written(small, "links")
        drop_folder(spark, old)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum((F.col("b") != F.col("a")).cast("int"))).first()
        if state == before:
            break
        before = state
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.union(leaves.select("root", "root").distinct())
