"""Mixing sources to target weights that change over the training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areascore.llm.common import n_words, running, settled, stored

#: Weights by the place of a source, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: For each weight, how it changes over the training: (time from 0 to 1, factor), linear in between.
SCHEDULES = (
    ((0.0, 1.4), (1.0, 0.6)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.4), (0.5, 1.0), (1.0, 1.6)),
)


def source_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``sources`` (``source``, ``source_size``) with ``place`` (by code point, null last), ``weight`` and ``target``.

    All targets together are ``share`` times all sizes, in proportion to the weights; none exceeds ``most``
    times its source. What a full source can't take is shared by the others again by weight. In order of
    capacity per weight the full sources come first, so one pass over running sums finds the common
    level: target = least(capacity, level * weight).
    """
    listed = running(sources, [F.col("source").isNull(), F.col("source")], {"size": F.col("source_size")})
    place = F.col("row_before")
    listed = listed.select(
        "source", "source_size", place.cast("long").alias("place"),
        F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("size_total") * F.lit(float(share))).alias("_budget"),
        (F.col("source_size") * F.lit(float(most))).alias("_cap"),
    )
    ranked = running(
        listed, [F.col("_cap") / F.col("weight"), F.col("place")], {"cap": F.col("_cap"), "w": F.col("weight")}
    )
    level = (F.col("_budget") - F.col("cap_before")) / (F.col("w_total") - F.col("w_before"))
    ranked = settled(ranked.withColumn("_level", level).withColumn("_full", F.col("_cap") <= level * F.col("weight")))
    common = ranked.filter(~F.col("_full")).agg(F.min_by("_level", "row_before")).first()[0]
    shared = F.lit(common).cast("double") * F.col("weight")
    return ranked.select(
        "source", "source_size", "place", "weight", F.least("_cap", shared).alias("target")
    )


def _segments(schedule: Sequence[tuple[float, float]]) -> tuple[list[tuple[float, float, float, float, float]], float]:
    """(start, width, factor at start, slope, integral before) of each linear piece, and the whole integral."""
    pieces, total = [], 0.0
    for (t0, f0), (t1, f1) in zip(schedule, schedule[1:]):
        pieces.append((t0, t1 - t0, f0, (f1 - f0) / (t1 - t0), total))
        total += (f0 + f1) / 2 * (t1 - t0)
    return pieces, total


def position(done: Column, schedule: Sequence[tuple[float, float]]) -> Column:
    """Time at which the part ``done`` (0 to 1) of a source's words is used up under ``schedule``.

    The demand up to time t is the integral of the schedule; each linear piece is inverted by the root
    of its square law.
    """
    pieces, total = _segments(schedule)
    want, out = done * F.lit(total), None
    for t0, width, f0, slope, before in pieces:
        rest = F.greatest(want - F.lit(before), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(f0 * f0) + rest * F.lit(2 * slope), F.lit(0.0)))
        # rest = f0 * x + slope / 2 * x^2, solved without a difference of near equal numbers
        x = F.when(rest <= 0, F.lit(0.0)).otherwise(rest * 2 / (root + F.lit(f0)))
        at = F.lit(t0) + F.least(x, F.lit(width))
        out = at if out is None else F.when(want >= F.lit(before), at).otherwise(out)
    return out


def _timed(schedule: Sequence[tuple[float, float]]):
    return lambda middle: position(middle / F.col("target"), schedule)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    share: float = 1.5,
    most: int = 2,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 1,
) -> DataFrame:
    """One row per document with ``size`` (words), its source's ``source_size`` and ``target``, ``taken`` (words
    that the mix takes, repeats counted) and ``positions`` (training time of each use, from 0 to 1).

    Inside its source a document stands at a place drawn from a hash of its key; the source's words are
    used in that order, and again from the start, until the target is met: a use counts if its middle lies
    before the target, so a source misses its target by at most half a document. A use's position is the
    time at which its source's demand, the integral of its schedule, reaches the use's middle.

    Documents without words are never taken. A null source is a source of its own, and the last; null or
    repeated keys are ordered by size and digest, equal rows are interchangeable; an empty table gives no rows;
    other columns are ignored.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(key)))
    rows = settled(
        docs.select(
            F.col(key).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
            digest.alias("_draw"), F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("")).alias("_text"),
            _identity(key, source, text).alias("_same"),
        )
    )
    targets = settled(
        source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    )
    named = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).select(
        rows["*"], "place", "source_size", "target"
    )
    order = [F.col(c) for c in ("place", "_draw", "doc_id", "size", "_text")]
    used = running(named, order, {"words": F.col("size")}, group="place")
    middle = lambda turn: F.col("words_before") + turn * F.col("source_size") + F.col("size") / 2
    uses = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(most - 1)), middle),
        lambda m: (F.col("size") > 0) & (m < F.col("target")),
    )
    used = used.withColumn("_uses", uses)
    kind = F.col("place") % len(schedules)
    at = None
    for i, schedule in enumerate(schedules):
        times = F.transform("_uses", _timed(schedule))
        at = times if at is None else F.when(kind == i, times).otherwise(at)
    return used.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.size("_uses")).alias("taken"),
        at.alias("positions"), "_same",
    )


def order_by_position(mixed: DataFrame) -> DataFrame:
    """``mixed`` range-sorted by the first use; documents that are never used come last."""
    return mixed.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")


#: Identities with several rows up to which they are broadcast, 32 bytes each.
BROADCAST_SAME = 1_000_000


def training_order(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` as the mix uses them, repeats included, range-sorted by position; all columns
    stay as they are. Rows equal in key, source and text share their uses in any order; each of them meets one use, by
    a number that both get in ranges, so that a row that is repeated often spreads over many tasks."""
    source = options.get("source", "source")
    uses = mix(docs, key=key, text=text, **options).select(F.col("_same").alias("_used"), "positions")
    uses = stored(uses, "uses")
    given = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), _identity(key, source, text).alias("_same")
    )
    again = settled(uses.groupBy("_used").agg(F.count("*").alias("_n")).filter("_n > 1").select("_used"))
    several = again.count()
    if not several:
        met = given.join(uses, F.col("_same") == F.col("_used"))
    else:
        known = F.broadcast(again) if several <= BROADCAST_SAME else again
        # joined by the identity alone, so that the rows, texts and all, cross the network once before the sort
        met = given.join(uses.join(known, "_used", "left_anti"), F.col("_same") == F.col("_used")).select("_row", "positions")
        rows = _numbered(given.join(known, F.col("_same") == F.col("_used"), "left_semi"), "_same")
        turns = _numbered(uses.join(known, "_used", "left_semi"), "_used").withColumnRenamed("row_before", "_turn")
        both = rows.join(turns, (F.col("_same") == F.col("_used")) & (F.col("row_before") == F.col("_turn")))
        met = met.union(both.select("_row", "positions"))
    placed = met.select("_row", F.explode("positions").alias("_at"))
    return placed.orderBy("_at", F.col("_row").getField(key)).select("_row.*")


def _numbered(rows: DataFrame, same: str) -> DataFrame:
    """``rows`` with ``row_before``, their number among those with equal ``same``; equal rows are dealt over many ranges."""
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    return running(salted, [F.col(same), F.col("_salt")], {}, group=same).drop("_salt")


def _identity(key: str, source: str, text: str) -> Column:
    """A digest that rows share if they are equal in key, source and text."""
    parts = [F.col(key).cast("string"), F.col(source).cast("string"), F.md5(F.col(text).cast("binary"))]
    return F.md5(F.concat_ws("\u0001", *(F.coalesce(p, F.lit("\u0002")) for p in parts)))
