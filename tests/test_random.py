"""Random tables with a hot key, checked against plain Python."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from areascore.operators import aggregates as agg
from areascore.operators import windows
from areascore.sources import tables

DAY0 = date(2023, 12, 20)
SCHEMA = "id int, k string, d date, a double, b double"


def table(seed, n=800):
    """Half of the rows carry one key; values repeat and are often missing."""
    rng = random.Random(seed)
    pick = lambda: rng.choice([None, *range(5)])
    return [
        (
            i,
            "hot" if rng.random() < 0.5 else rng.choice([None, *"uvwxyz"]),
            DAY0 + timedelta(days=rng.randrange(80)),
            None if (v := pick()) is None else float(v),
            None if (v := pick()) is None else v / 2,
        )
        for i in range(n)
    ]


def grouped(data):
    groups = defaultdict(list)
    for row in data:
        groups[row[1]].append(row)
    return groups


@pytest.fixture(params=[1, 2, 3])
def case(request, spark):
    data = table(request.param)
    return data, spark.createDataFrame(data, SCHEMA).repartition(5)


def test_latest_and_first(case):
    data, df = case
    want = {k: max(g, key=lambda r: (r[2], -r[0]))[0] for k, g in grouped(data).items()}
    assert dict(rows(windows.latest_per(df, ["k"], "d", ["id"]), "k", "id")) == want
    want = {k: min(g, key=lambda r: (r[2], -r[0]))[0] for k, g in grouped(data).items()}
    assert dict(rows(windows.dedup(df, ["k"], ["d", F.col("id").desc()]), "k", "id")) == want


def test_argmax(case):
    data, df = case
    want = {
        k: min(g, key=lambda r: (r[3] is None, -(r[3] or 0), r[0]))[0] for k, g in grouped(data).items()
    }
    assert dict(rows(windows.argmax_by(df, "k", "a", ["id"]), "k", "id")) == want


def test_latest_nonnull(case):
    data, df = case
    one_per_day = list({(r[1], r[2]): r for r in data}.values())
    def last(g, c):
        known = [r for r in g if r[c] is not None]
        return max(known, key=lambda r: r[2])[c] if known else None
    want = sorted(((k, last(g, 3), last(g, 4)) for k, g in grouped(one_per_day).items()), key=repr)
    kept = df.sparkSession.createDataFrame(one_per_day, SCHEMA)
    assert rows(agg.latest_nonnull(kept, "k", "d", ["a", "b"])) == want


def test_loss(case):
    data, df = case
    rules = {"no_a": F.col("a").isNotNull(), "small_b": F.col("b") >= 1, "cold": F.col("k") == "hot"}
    alive = data
    want = {"rows_in": len(data)}
    for name, keep in {
        "no_a": lambda r: r[3] is not None, "small_b": lambda r: r[4] is not None and r[4] >= 1, "cold": lambda r: r[1] == "hot",
    }.items():
        left = [r for r in alive if keep(r)]
        want[f"dropped_{name}"] = len(alive) - len(left)
        alive = left
    want["rows_kept"] = len(alive)
    got = agg.count_loss(df, rules).head().asDict()
    assert {k: got[k] for k in want} == want
    kept, _ = agg.observe_loss(df, rules)
    assert [r[0] for r in sorted(kept.collect())] == sorted(r[0] for r in alive)


def test_replacements(case):
    data, df = case
    cutoff = date(2024, 1, 17)
    fresh = [r for r in table(99, 200) if r[2] >= cutoff]
    new = df.sparkSession.createDataFrame(fresh, SCHEMA)
    want = sorted(([r for r in data if r[2] < cutoff] + fresh), key=repr)
    assert rows(tables.replace_from(df, new, "d", "2024-01-17")) == want
    days = {r[2] for r in fresh}
    want = sorted(([r for r in data if r[2] not in days] + fresh), key=repr)
    assert rows(tables.replace_keys(df, new, "d")) == want
    pairs = {(r[2], r[1]) for r in fresh if r[1] is not None}
    want = sorted(([r for r in data if (r[2], r[1]) not in pairs] + fresh), key=repr)
    assert rows(tables.replace_keys(df, new, "d", "k")) == want


def test_latest_month(case):
    data, df = case
    month = lambda r: (r[2].year, r[2].month)
    want = []
    for k, g in grouped(data).items():
        top = max(map(month, g))
        kept = [r for r in g if month(r) == top]
        if k is not None:
            want += kept
    got = windows.latest_month_rows(df, "k", "d")
    assert rows(got, *df.columns) == sorted(want, key=repr)
