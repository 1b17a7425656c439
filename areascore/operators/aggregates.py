"""Aggregations. Counts, sums and extremes combine on the map side; medians are exact and
have their own way for groups too large for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from areascore.functions.numbers import Rounding
from areascore.functions.times import month_of
from areascore.session import settle, store

# A group of at most this many rows is sorted in one task as an array of doubles. Larger groups
# take the bracketed way below, which never brings a group together.
HOT_ROWS = 1_000_000

# Up to this many hot groups their keys and brackets are broadcast; beyond it they are joined by
# shuffle, where the adaptive planner splits skewed keys.
BROADCAST_GROUPS = 100_000

# Half-width of the first bracket around the middle, ten times the sketch's rank error.
_HALF_WIDTH = 0.001
_ACCURACY = 10_000
_CUTS = [i / 100 for i in range(1, 100)]


def _same(keys: Sequence[str]) -> Column:
    """Null-safe equality on ``keys``; the right side carries them under a prefix."""
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in keys))


def _prefixed(df: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*(F.col(k).alias(f"_on_{k}") for k in keys), *keep)


def grouped_medians(
    df: DataFrame,
    keys: Sequence[str],
    medians: Mapping[str, str],
    rows: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Exact interpolated medians per group, nulls skipped; optionally the row count too.

    ``medians`` maps output name to input column. NaN is a value, larger than any other, whatever
    the size of its group. The input's plan runs once: its keys and inputs are written as columns, and group sizes are
    counted there from the keys alone. Groups within ``hot_rows`` are sorted whole; the others, if
    there are any, are found without being brought together. Columns have names of their own
    inside, so any key or column name will do.
    """
    inputs = sorted(set(medians.values()))
    key_as = {k: f"key_{i}" for i, k in enumerate(dict.fromkeys(keys))}
    in_as = {c: f"in_{i}" for i, c in enumerate(inputs)}
    out_as = {out: f"out_{i}" for i, out in enumerate(medians)}
    slim = df.select(
        *(df[k].alias(n) for k, n in key_as.items()), *(df[c].cast("double").alias(n) for c, n in in_as.items())
    )
    found = _medians(
        store(slim, "medians"), [*key_as.values()], {out_as[out]: in_as[c] for out, c in medians.items()}, "n_rows" if rows else None, hot_rows
    )
    named = {**{n: k for k, n in key_as.items()}, **{n: out for out, n in out_as.items()}, **({"n_rows": rows} if rows else {})}
    return found.select(*(F.col(n).alias(name) for n, name in named.items()))


def _medians(slim: DataFrame, keys: list[str], medians: Mapping[str, str], rows: str | None, hot_rows: int) -> DataFrame:
    inputs = sorted(set(medians.values()))
    sizes = slim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    # Few rows, read by the count and by each of the branches.
    hot = settle(sizes.filter(F.col("_rows") > hot_rows))
    found = hot.count()
    if found == 0:
        return _sorted_medians(slim, keys, medians, rows)
    hot = _prefixed(hot, keys, ["_rows"])
    fits = found <= BROADCAST_GROUPS
    small = slim.join(_hinted(hot, fits), _same(keys), "left_anti")
    return _sorted_medians(small, keys, medians, rows).unionByName(
        _hot_medians(slim, hot, fits, keys, inputs, medians, rows)
    )


def _hinted(df: DataFrame, fits: bool) -> DataFrame:
    return F.broadcast(df) if fits else df


def _sorted_medians(df: DataFrame, keys: list[str], medians: Mapping[str, str], rows: str | None) -> DataFrame:
    """Medians of groups small enough to sort whole."""
    inputs = sorted(set(medians.values()))
    counted = [F.count(F.lit(1)).alias(rows)] if rows else []
    lists = df.groupBy(*keys).agg(*(F.sort_array(F.collect_list(c)).alias(f"_{c}") for c in inputs), *counted)

    def middle(c: str) -> Column:
        values, n = F.col(f"_{c}"), F.size(f"_{c}")
        low = F.get(values, F.floor((n - 1) / 2).cast("int"))
        return low * 0.5 + F.get(values, F.floor(n / 2).cast("int")) * 0.5

    return lists.select(
        *keys, *(middle(c).alias(out) for out, c in medians.items()), *([rows] if rows else [])
    )


def _hot_medians(
    slim: DataFrame,
    hot: DataFrame,
    fits: bool,
    keys: list[str],
    inputs: list[str],
    medians: Mapping[str, str],
    rows: str | None,
) -> DataFrame:
    """Exact medians of groups of any size, without bringing one group into one task.

    1. A mergeable sketch gives a bracket around the middle of each group.
    2. Values inside the bracket are counted per distinct value; everything below it is one
       count. Both combine on the map side and are spread by value.
    3. Those distinct values are cut into 100 bins of about equal size; cumulative bin counts
       (at most 101 rows per group) tell which one or two bins hold the middle ranks.
    4. Only these bins are ordered.

    The bracket is checked against the exact counts, so a sketch that were off would fail
    loudly and never give a wrong median.
    """
    group = [*keys, "_metric"]
    members = slim.join(_hinted(hot, fits), _same(keys), "left_semi")
    long = members.unpivot(keys, inputs, "_metric", "_value").filter("_value is not null")

    # The sketch doesn't order NaN, so NaN counts as infinity there, and an infinite upper end includes it.
    top = F.lit(float("inf"))
    sketch = long.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx(
            F.when(F.isnan("_value"), top).otherwise(F.col("_value")), [0.5 - _HALF_WIDTH, 0.5 + _HALF_WIDTH], _ACCURACY
        ).alias("_bracket"),
    )
    upper = F.when(F.col("_bracket")[1] == top, F.lit(float("nan"))).otherwise(F.col("_bracket")[1])
    sketch = sketch.withColumn("_bracket", F.array(F.col("_bracket")[0], upper))
    ranks = _prefixed(sketch, group, ["_n", "_bracket"])
    near = long.join(_hinted(ranks, fits), _same(group)).filter(
        F.col("_value") <= F.col("_bracket")[1]
    )
    inside_bracket = F.when(F.col("_value") >= F.col("_bracket")[0], F.col("_value"))
    # A small share of the values, read three times below.
    counts = settle(
        near.groupBy(*group, inside_bracket.alias("_value"), "_n").agg(F.count(F.lit(1)).alias("_c"))
    )

    cuts = _prefixed(
        counts.filter("_value is not null")
        .groupBy(*group)
        .agg(F.percentile_approx("_value", _CUTS, _ACCURACY).alias("_cuts")),
        group,
        ["_cuts"],
    )
    binned = counts.join(_hinted(cuts, fits), _same(group)).select(
        *group,
        "_value",
        "_n",
        "_c",
        F.when(F.col("_value").isNull(), -1)
        .otherwise(F.size(F.filter("_cuts", lambda cut: cut < F.col("_value"))))
        .alias("_bin"),
    )

    low = F.floor((F.col("_n") + 1) / 2)
    high = F.floor(F.col("_n") / 2) + 1
    along = W.partitionBy(*group).orderBy("_bin")
    placed = (
        binned.groupBy(*group, "_n", "_bin")
        .agg(F.sum("_c").alias("_in_bin"))
        .withColumn("_upto", F.sum("_in_bin").over(along))
        .withColumn("_before", F.col("_upto") - F.col("_in_bin"))
        .filter((F.col("_before") < high) & (F.col("_upto") >= low))
    )
    spots = _prefixed(placed, [*group, "_bin"], ["_before"])
    inside = binned.join(_hinted(spots, fits), _same([*group, "_bin"]))
    ladder = W.partitionBy(*group, "_bin").orderBy("_value").rowsBetween(W.unboundedPreceding, 0)
    ranked = inside.withColumn("_upto", F.col("_before") + F.sum("_c").over(ladder))
    lower = F.min(F.when((F.col("_upto") >= low) & (F.col("_bin") >= 0), F.col("_value")))
    upper = F.min(F.when((F.col("_upto") >= high) & (F.col("_bin") >= 0), F.col("_value")))
    off = F.max(F.col("_bin") < 0) | upper.isNull()
    found = ranked.groupBy(*group).agg(
        F.when(off, F.raise_error(F.lit("median bracket missed the middle")).cast("double"))
        .otherwise(lower * 0.5 + upper * 0.5)
        .alias("_median")
    )

    wide = found.groupBy(*keys).agg(
        *(F.max(F.when(F.col("_metric") == c, F.col("_median"))).alias(out) for out, c in medians.items())
    )
    # A group whose values are all null has no row in ``wide`` but keeps its place.
    joined = hot.join(wide, _same(keys), "left")
    return joined.select(
        *(F.col(f"_on_{k}").alias(k) for k in keys),
        *medians,
        *([F.col("_rows").alias(rows)] if rows else []),
    )


def monthly_medians(
    df: DataFrame,
    key: str,
    date: str,
    cols: Mapping[str, str],
    rows: str = "week_count",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Medians and row count per area and calendar month."""
    monthly = df.withColumn("period_month", month_of(F.col(date)))
    return grouped_medians(monthly, [key, "period_month"], cols, rows=rows, hot_rows=hot_rows)


def all_area_monthly(
    df: DataFrame,
    cols: Mapping[str, str],
    constants: Mapping[str, str] | None = None,
    month: str = "period_month",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Medians over all areas per month; ``constants`` are the same for every area of a month."""
    out = grouped_medians(df, [month], cols, hot_rows=hot_rows)
    if constants:
        fixed = df.groupBy(month).agg(*(F.max(c).alias(name) for name, c in constants.items()))
        out = out.join(fixed, month)
    return out


def median_by(
    df: DataFrame, key: str, col: str, out: str | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Median of the non-null values per key."""
    return grouped_medians(df.filter(F.col(col).isNotNull()), [key], {out or col: col}, hot_rows=hot_rows)


def count_by(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def count_and_sum(
    df: DataFrame, keys: Sequence[str], col: str, n: str, total: str, money_scale: int | None = None
) -> DataFrame:
    """Count and sum that skips nulls; ``money_scale`` sums exactly as decimals."""
    amount = F.col(col) if money_scale is None else F.col(col).cast(f"decimal(28,{money_scale})")
    summed = F.sum(amount) if money_scale is None else F.sum(amount).cast("double")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), summed.alias(total))


def monthly_mean(
    df: DataFrame, date: str, col: str, digits: int = 2, out: str | None = None,
    mean=F.avg, rounding: Rounding = F.round,
) -> DataFrame:
    """Rounded mean per calendar month."""
    return df.groupBy(month_of(F.col(date)).alias("period_month")).agg(
        rounding(mean(F.col(col)), digits).alias(out or col)
    )


def latest_nonnull(df: DataFrame, key: str | None, order: str, cols: Sequence[str]) -> DataFrame:
    """Per column, the value at the latest ``order`` where that column is not null."""
    picks = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols]
    return df.agg(*picks) if key is None else df.groupBy(key).agg(*picks)


def extreme_area(df: DataFrame, col: str, which: str, key: str = "zip_code", missing: str | None = "N/A") -> Column:
    """Aggregate: the area with the smallest or largest ``col``, lowest code on ties; ``missing`` where none has a value."""
    if which not in ("min", "max"):
        raise ValueError(f"which must be min or max, not {which!r}")
    rank = F.col(col) if which == "min" else -F.col(col)
    best = F.min(F.when(F.col(col).isNotNull(), F.struct(rank.alias("r"), F.col(key).alias("k"))))
    return F.coalesce(best["k"].cast("string"), F.lit(missing).cast("string"))


def whole_medians(df: DataFrame, medians: Mapping[str, str]) -> DataFrame:
    """One row with the exact interpolated medians of whole columns, nulls skipped; null where there is no value.

    Values are counted per distinct value, which combines on the map side, and dealt into ranges in their order. Counts of the
    ranges tell which ones hold the middle ranks; only those are numbered, each by itself. No task has
    more than a range, whatever the size of the table, and a frequent value is one row.
    """
    inputs = {c: f"in_{i}" for i, c in enumerate(sorted(set(medians.values())))}
    slim = df.select(*(df[c].cast("double").alias(n) for c, n in inputs.items()))
    long = slim.unpivot([], [*inputs.values()], "_metric", "_value").filter("_value is not null")
    counts = long.groupBy("_metric", "_value").agg(F.count(F.lit(1)).alias("_c"))
    dealt = settle(counts.repartitionByRange("_metric", "_value").withColumn("_part", F.spark_partition_id()))
    whole = W.partitionBy("_metric")
    ranges = dealt.groupBy("_metric", "_part").agg(F.sum("_c").alias("_in"))  # one row a range and metric
    ranges = ranges.withColumns({"_n": F.sum("_in").over(whole), "_upto": F.sum("_in").over(whole.orderBy("_part"))})
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    before = F.col("_upto") - F.col("_in")
    spots = ranges.filter((before < high) & (F.col("_upto") >= low)).select("_metric", "_part", "_n", before.alias("_before"))
    ladder = W.partitionBy("_metric", "_part").orderBy("_value").rowsBetween(W.unboundedPreceding, 0)
    ranked = dealt.join(F.broadcast(spots), ["_metric", "_part"])  # at most two rows a metric
    ranked = ranked.withColumn("_upto", F.col("_before") + F.sum("_c").over(ladder))
    at = lambda rank: F.min(F.when(F.col("_upto") >= rank, F.col("_value")))
    found = ranked.groupBy("_metric").agg((at(low) * 0.5 + at(high) * 0.5).alias("_median"))
    return found.agg(*(F.max(F.when(F.col("_metric") == inputs[c], F.col("_median"))).alias(out) for out, c in medians.items()))


def kpis(df: DataFrame, specs: Mapping[str, Column | tuple[str, str]]) -> DataFrame:
    """One row of key figures. A spec is an aggregate Column or ``("median", column)``."""
    medians = {name: spec[1] for name, spec in specs.items() if isinstance(spec, tuple)}
    plain = [spec.alias(name) for name, spec in specs.items() if not isinstance(spec, tuple)]
    out = df.agg(*plain, F.count(F.lit(1)).alias("_rows"))
    if medians:
        found = whole_medians(df, medians).select(F.struct(*medians).alias("m")).scalar()
        out = out.withColumn("_m", found).withColumns({name: F.col("_m")[name] for name in medians})
    return out.select(*specs)


def high_water(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias(col))


def periods(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def first_failed(rules: Mapping[str, Column]) -> Column:
    """Name of the first rule that a row fails; null if it passes all. A rule that is null fails."""
    out = None
    for name, keep in rules.items():
        failed = ~F.coalesce(keep, F.lit(False))
        out = F.when(failed, name) if out is None else out.when(failed, name)
    return F.lit(None).cast("string") if out is None else out


def _loss_counts(rules: Mapping[str, Column]) -> list[Column]:
    """Count per rule of the rows it is the first to drop, and of the rows that pass all."""
    counts, alive = [F.count(F.lit(1)).alias("rows_in")], F.lit(True)
    for name, keep in rules.items():
        keep = F.coalesce(keep, F.lit(False))
        counts.append(F.count_if(alive & ~keep).alias(f"dropped_{name}"))
        alive = alive & keep
    return [*counts, F.count_if(alive).alias("rows_kept")]


def count_loss(df: DataFrame, rules: Mapping[str, Column], rounding: Rounding = F.round) -> DataFrame:
    """One row: rows in, dropped per rule in order, kept, percent kept."""
    share = F.col("rows_kept") / F.nullif(F.col("rows_in"), F.lit(0)) * 100
    return df.agg(*_loss_counts(rules)).withColumn("percent_kept", rounding(share, 1))


def observe_loss(
    df: DataFrame, rules: Mapping[str, Column], name: str | None = None
) -> tuple[DataFrame, Observation]:
    """The rows that pass all rules, with the loss counted in the same pass.

    For reports only: a stage that is repeated after an executor is lost counts again.
    """
    observation = Observation(name) if name else Observation()
    kept = df.observe(observation, *_loss_counts(rules))
    for keep in rules.values():
        kept = kept.filter(keep)
    return kept, observation


def summarise_checks(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("tests_run"), F.count_if(F.col("status") == "pass").alias("tests_passed")
    )
