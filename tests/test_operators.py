import math
import random
import statistics
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from areascore.operators import aggregates as agg
from areascore.operators import filters, joins, ordering, reshape, windows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- filters ----------------------------------------------------------------------------------


def test_code_range_is_inclusive_and_lenient(spark):
    df = spark.createDataFrame([(z,) for z in ("36999", "37000", "38599", "38600", "abc", None)], "zcta string")
    assert rows(filters.in_code_range(df, "zcta", 37000, 38599)) == [("37000",), ("38599",)]


def test_small_filters(spark):
    df = spark.createDataFrame([("TN", "a", 1.0), ("NC", "", None), ("TN", None, -2.0), (None, "NA", 0.0)], "s string, t string, v double")
    assert filters.keep_state(df, "s", "TN").count() == 2
    assert filters.keep_state(df, "s", "GA").count() == 0
    assert filters.keep_codes(df, "s", ["NC", "GA"]).count() == 1
    assert filters.drop_null(df, ["s", "t"]).count() == 2
    assert rows(filters.drop_blank(df, "t"), "t") == [("NA",), ("a",)]
    assert rows(filters.drop_sentinel(df, "t", "NA"), "t") == [("",), ("a",)]
    assert rows(filters.positive_only(df, "v"), "v") == [(1.0,)]
    assert filters.exclude_value(df, "s", "TN").count() == 1
    assert filters.one_area(df, "NC", "s").count() == 1


def test_drop_all_null_keeps_partial_rows(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.0, None), (3, None, 2.0)], "k int, a double, b double")
    assert rows(filters.drop_all_null(df, ["a", "b"]), "k") == [(2,), (3,)]


@pytest.mark.parametrize("mark, kept", [(None, 3), ("2023-12-31", 3), ("2024-01-31", 2), ("2024-03-31", 0)])
def test_newer_than(spark, mark, kept):
    df = spark.createDataFrame([(date(2024, 1, 31),), (date(2024, 2, 29),), (date(2024, 3, 31),)], ["p"])
    assert filters.newer_than(df, "p", mark).count() == kept


@pytest.mark.parametrize("mark, kept", [(None, [2022, 2023, 2024]), ("2022", [2023, 2024]), ("2024", [])])
def test_newer_versions(spark, mark, kept):
    df = spark.createDataFrame([(2022,), (2023,), (2024,)], "vintage_year int")
    assert [r[0] for r in rows(filters.newer_versions(df, "vintage_year", mark))] == kept
    assert rows(filters.pin_vintage(df)) == [(2023,)]


def test_from_bound_is_inclusive_for_dates_and_times(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), datetime(2024, 1, 1, 12))], "d date, t timestamp_ntz")
    assert filters.from_bound(df, "d", "2024-01-01").count() == 1
    assert filters.from_bound(df, "t", "2024-01-01T12:00:00").count() == 1
    assert filters.from_bound(df, "t", "2024-01-01T12:00:01").count() == 0


def test_valid_sales(spark):
    df = spark.createDataFrame([("Y",), ("N",), (None,)], "valid_sale string")
    assert filters.valid_sales(df).count() == 1


# -- reshape ----------------------------------------------------------------------------------


def test_unpivot_months(spark):
    df = spark.createDataFrame(
        [("37203", "TN", "450000.0", None), ("37027", "TN", "1", "2")], ["RegionName", "State", "2024-01-31", "2024-02-29"]
    )
    long = reshape.unpivot_months(df, ["RegionName", "State"], "ZHVI")
    assert dict(long.dtypes)["period_month"] == "date"
    assert rows(long, "RegionName", "period_month", "value", "metric_type") == [
        ("37027", date(2024, 1, 31), 1.0, "ZHVI"),
        ("37027", date(2024, 2, 29), 2.0, "ZHVI"),
        ("37203", date(2024, 1, 31), 450000.0, "ZHVI"),
    ]


def test_unpivot_without_month_columns_fails(spark):
    with pytest.raises(ValueError, match="no month columns"):
        reshape.unpivot_months(spark.createDataFrame([("1", "TN")], ["RegionName", "SizeRank"]), ["RegionName"], "ZHVI")


def test_pivot_metrics(spark):
    df = spark.createDataFrame(
        [("1", date(2024, 1, 31), 1.0, "ZHVI"), ("1", date(2024, 1, 15), 3.0, "ZHVI"), ("1", date(2024, 1, 31), 2.0, "ZORI"),
         ("1", date(2024, 2, 1), 9.0, "other")],
        "zip_code string, period_month date, value double, metric_type string",
    )
    assert rows(reshape.pivot_metrics(df)) == [
        ("1", date(2024, 1, 1), 3.0, 2.0, None), ("1", date(2024, 2, 1), None, None, None),
    ]


def test_stamp_and_union_and_freshness(spark):
    df = reshape.stamp(spark.range(1), series_id="S", vintage_year=2023)
    assert rows(df) == [(0, "S", 2023)]
    stamped = reshape.stamp_ingested(spark.range(3), datetime(2024, 1, 1, 2, 3, 4))
    assert {r["ingested_at"] for r in stamped.collect()} == {datetime(2024, 1, 1, 2, 3, 4)}
    assert reshape.union_all([spark.range(2), spark.range(3)]).count() == 5
    audit = spark.createDataFrame([("r", "pass", None)], "run_id string, freshness_market string, freshness_crime string")
    assert rows(reshape.unpivot_freshness(audit)) == [("crime", None), ("market", "pass")]


# -- medians ----------------------------------------------------------------------------------


def brute(data, key, value):
    groups = {}
    for row in data:
        groups.setdefault(row[key], []).append(row[value])
    return {
        k: (statistics.median(known) if (known := [v for v in vs if v is not None]) else None, len(vs))
        for k, vs in groups.items()
    }


@pytest.mark.parametrize("hot_rows", [10**6, 100, 0])
def test_medians_against_brute_force(spark, hot_rows):
    rng = random.Random(5)
    data = [("hot", rng.choice([rng.random() * 1e6, 7.0, -3.0, None]), float(i % 3)) for i in range(6001)]
    data += [("ties", 4.0 if i < 400 else 5.0, None) for i in range(800)]
    data += [("wide", 10.0 ** rng.randint(-300, 300), float(i)) for i in range(1000)]
    data += [(f"k{i % 50}", float(rng.randint(-5, 5)), rng.random()) for i in range(333)]
    data += [(None, 1.0, 2.0), (None, 2.0, None), ("empty", None, None)]
    df = spark.createDataFrame(data, "k string, a double, b double").repartition(7)
    got = agg.grouped_medians(df, ["k"], {"ma": "a", "mb": "b"}, rows="n", hot_rows=hot_rows)
    a, b = brute(data, 0, 1), brute(data, 0, 2)
    want = {k: (a[k][0], b[k][0], a[k][1]) for k in a}
    assert {r["k"]: (r["ma"], r["mb"], r["n"]) for r in got.collect()} == want


def test_medians_mean_one_thing_at_every_size(spark):
    """NaN is the largest value, infinities are values, and column names don't matter, however large a group is."""
    nan, inf = math.nan, math.inf
    data = [("n", v) for v in (nan, 1.0, 2.0, nan, 3.0)] + [("i", v) for v in (-inf, inf, 5.0, 4.0, None)]
    data += [(None, v) for v in (7.0, None, 9.0)] + [("e", None), ("m", nan), ("m", nan), ("m", 1.0)]
    names = ["_value", "_rows"]
    df = spark.createDataFrame(data, "`_value` string, `_rows` double")
    got = [
        sorted(map(str, agg.grouped_medians(df, names[:1], {"_metric": "_rows"}, rows="_n", hot_rows=h).collect()))
        for h in (0, 2, 10**6)
    ]
    assert got[0] == got[1] == got[2]
    want = {("n", "3.0"), ("i", "4.5"), (None, "8.0"), ("e", "None"), ("m", "nan")}
    found = agg.grouped_medians(df, names[:1], {"_metric": "_rows"}, rows="_n").collect()
    assert {(r["_value"], str(r["_metric"])) for r in found} == want
    by = [sorted(map(str, agg.median_by(df, "_value", "_rows", hot_rows=h).collect())) for h in (0, 10**6)]
    assert by[0] == by[1]


def test_hot_groups_beyond_the_broadcast_limit(spark, monkeypatch):
    data = [(i % 4, float(i)) for i in range(999)]
    df = spark.createDataFrame(data, "k int, a double")
    monkeypatch.setattr(agg, "BROADCAST_GROUPS", 1)
    got = agg.grouped_medians(df, ["k"], {"m": "a"}, rows="n", hot_rows=249)
    assert {r["k"]: (r["m"], r["n"]) for r in got.collect()} == brute(data, 0, 1)


def test_monthly_medians(spark):
    data = [("1", date(2024, 1, d), float(d), None) for d in (3, 10, 17, 24)] + [("1", date(2024, 2, 1), 5.0, None), ("2", date(2024, 1, 1), 1.0, None)]
    df = spark.createDataFrame(data, "zip_code string, period_end date, dom double, mos double")
    out = agg.monthly_medians(df, "zip_code", "period_end", {"median_dom": "dom", "median_mos": "mos"})
    assert rows(out, "zip_code", "period_month", "median_dom", "median_mos", "week_count") == [
        ("1", date(2024, 1, 1), 13.5, None, 4), ("1", date(2024, 2, 1), 5.0, None, 1), ("2", date(2024, 1, 1), 1.0, None, 1),
    ]


def test_median_by_and_all_area(spark):
    df = spark.createDataFrame(
        [("a", date(2024, 1, 1), 1.0, 6.5), ("b", date(2024, 1, 1), 4.0, 6.5), ("b", date(2024, 2, 1), None, None)],
        "zip_code string, period_month date, v double, rate double",
    )
    assert rows(agg.median_by(df, "zip_code", "v")) == [("a", 1.0), ("b", 4.0)]
    assert rows(agg.all_area_monthly(df, {"m": "v"}, {"rate": "rate"})) == [
        (date(2024, 1, 1), 2.5, 6.5), (date(2024, 2, 1), None, None),
    ]


# -- other aggregates -------------------------------------------------------------------------


def test_counts_sums_means(spark):
    df = spark.createDataFrame([("1", 2023, 0.1), ("1", 2023, None), ("2", 2023, None)], "z string, y int, c double")
    assert rows(agg.count_by(df, ["z"])) == [("1", 2), ("2", 1)]
    assert rows(agg.count_and_sum(df, ["z", "y"], "c", "n", "t")) == [("1", 2023, 2, 0.1), ("2", 2023, 1, None)]
    assert rows(agg.count_and_sum(df, ["z", "y"], "c", "n", "t", money_scale=2)) == [("1", 2023, 2, 0.1), ("2", 2023, 1, None)]
    weekly = spark.createDataFrame([(date(2024, 1, 4), 6.62), (date(2024, 1, 18), 6.6), (date(2024, 2, 1), 7.0)], "d date, rate double")
    assert rows(agg.monthly_mean(weekly, "d", "rate")) == [(date(2024, 1, 1), 6.61), (date(2024, 2, 1), 7.0)]


def test_latest_nonnull_takes_each_column_from_its_own_month(spark):
    df = spark.createDataFrame(
        [("1", date(2024, 1, 1), 1.0, 9.0), ("1", date(2024, 2, 1), 2.0, None), ("2", date(2024, 1, 1), None, None)],
        "z string, m date, a double, b double",
    )
    assert rows(agg.latest_nonnull(df, "z", "m", ["a", "b"])) == [("1", 2.0, 9.0), ("2", None, None)]
    assert rows(agg.latest_nonnull(df, None, "m", ["a", "b"])) == [(2.0, 9.0)]


def test_whole_medians_against_brute_force(spark):
    rng, nan = random.Random(4), float("nan")
    for n in (0, 1, 2, 3, 10, 501, 2000):
        values = [(rng.choice([None, 1.0, 7.5, -0.0, rng.uniform(-9, 9)]), rng.choice([3.0, 3.0, nan, rng.random()]), None) for _ in range(n)]
        df = spark.createDataFrame(values, "a double, _value double, none double").repartition(7)
        (got,) = agg.whole_medians(df, {"_metric": "a", "b": "_value", "c": "none", "again": "a"}).collect()

        def median(column):
            held = sorted((v for v in column if v is not None), key=lambda v: (math.isnan(v), v))
            return held[(len(held) - 1) // 2] * 0.5 + held[len(held) // 2] * 0.5 if held else None

        want = [median([v[0] for v in values]), median([v[1] for v in values]), None]
        assert repr((got["_metric"], got["b"], got["c"])) == repr((want[0], want[1], None)).replace("-0.0", "0.0") and got["again"] == got["_metric"]


def test_places_follow_the_order(spark):
    from areascore.operators.ordering import ordered, with_places

    df = spark.range(0, 5000, numPartitions=7).selectExpr("pmod(hash(id), 50) k", "id")
    got = with_places(ordered(df, ["k", "id"])).collect()
    want = {r[1]: i for i, r in enumerate(sorted((r["k"], r["id"]) for r in df.collect()), 1)}
    assert {r["id"]: r["place"] for r in got} == want
    assert with_places(ordered(df.limit(0), ["k"])).count() == 0


def test_the_input_of_medians_is_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).selectExpr("id % 3 k", "cast(id as double) a").mapInArrow(note, "k long, a double")
    for hot in (10**6, 100):
        seen.value = 0
        assert len(agg.grouped_medians(df, ["k"], {"m": "a"}, rows="n", hot_rows=hot).collect()) == 3
        assert seen.value == 1000


def test_extremes_and_kpis(spark):
    df = spark.createDataFrame([("3", 5.0), ("1", 5.0), ("2", 1.0), ("4", None)], "zip_code string, r double")
    out = agg.kpis(
        df,
        {"low": agg.extreme_area(df, "r", "min"), "high": agg.extreme_area(df, "r", "max"), "mid": ("median", "r"),
         "mean": F.avg("r")},
    )
    assert rows(out) == [("2", "1", 5.0, 11 / 3)]
    none = df.filter("r > 100")
    assert rows(agg.kpis(none, {"low": agg.extreme_area(none, "r", "min"), "mid": ("median", "r")})) == [("N/A", None)]
    with pytest.raises(ValueError):
        agg.extreme_area(df, "r", "median")


def test_loss_is_attributed_to_the_first_rule(spark):
    df = spark.createDataFrame([("a", 1), ("", 1), (None, None), ("b", None)], "t string, v int")
    rules = {"blank": F.col("t") != "", "no_value": F.col("v").isNotNull()}
    assert agg.count_loss(df, rules).head().asDict() == {
        "rows_in": 4, "dropped_blank": 2, "dropped_no_value": 1, "rows_kept": 1, "percent_kept": 25.0,
    }
    kept, seen = agg.observe_loss(df, rules)
    assert rows(kept) == [("a", 1)]
    assert seen.get == {"rows_in": 4, "dropped_blank": 2, "dropped_no_value": 1, "rows_kept": 1}


def test_high_water_and_periods(spark):
    df = spark.createDataFrame([(date(2024, 2, 1),), (date(2024, 1, 1),), (date(2024, 2, 1),)], ["p"])
    assert agg.high_water(df, "p").head()[0] == date(2024, 2, 1)
    assert [r[0] for r in agg.periods(df, "p").collect()] == [date(2024, 1, 1), date(2024, 2, 1)]


# -- windows ----------------------------------------------------------------------------------


def test_latest_per_and_ties(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("a", 2, 3), ("b", 7, 1)], "k string, o int, t int")
    out = windows.latest_per(df, ["k"], "o", ["t"])
    assert rows(out) == [("a", 2, 3), ("b", 7, 1)]
    assert "WindowGroupLimit" in plan(out)


def test_dedup_is_deterministic(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 2.0), (2, 1.0)], "d int, rate double")
    assert rows(windows.dedup(df, ["d"], ["rate"])) == [(1, 2.0), (2, 1.0)]


def test_argmax(spark):
    df = spark.createDataFrame([("1", 5, "b"), ("1", 5, "a"), ("1", 4, "c"), ("2", 0, "z")], "k string, v int, t string")
    assert rows(windows.argmax_by(df, "k", "v", ["t"])) == [("1", 5, "a"), ("2", 0, "z")]


def test_latest_month_rows(spark):
    df = spark.createDataFrame([("1", date(2024, 1, 5)), ("1", date(2024, 2, 5)), ("1", date(2024, 2, 9)), ("2", date(2023, 1, 1))], "z string, d date")
    latest = windows.latest_month_rows(df, "z", "d")
    assert windows.latest_month_rows(df.limit(0), "z", "d").count() == 0
    assert rows(latest) == [("1", date(2024, 2, 5)), ("1", date(2024, 2, 9)), ("2", date(2023, 1, 1))]


def test_global_stats_need_no_join_and_no_single_task(spark):
    df = spark.createDataFrame([(2.0,), (100.0,), (None,)], "v double")
    out = windows.with_global_stats(df, ["v"])
    assert out.select("stats.*").head().asDict() == {"v_min": 2.0, "v_max": 100.0, "v_avg": 51.0, "v_min0": 0.0}
    text = plan(out)
    assert "NestedLoop" not in text and "Cartesian" not in text and "Window" not in text


# -- joins and order --------------------------------------------------------------------------


def test_restrict_to_repeats_nothing(spark):
    df = spark.createDataFrame([("1", 1), ("2", 2), (None, 3)], "zcta string, v int")
    valid = spark.createDataFrame([("1",), ("1",), ("9",)], "zip_code string")
    assert rows(joins.restrict_to(df, valid, "zip_code", "zcta")) == [("1", 1)]


def test_population_join(spark):
    counts = spark.createDataFrame([("1", 2023, 7), ("2", 2023, 1), ("9", 2023, 1)], "zip_code string, incident_year int, incident_count long")
    people = spark.createDataFrame([("1", 3000.0), ("2", 0.0)], "zip_code string, total_population double")
    assert rows(joins.with_population(counts, people), "zip_code", "incidents_per_1k") == [("1", 2.33), ("2", None)]


def test_against_all(spark):
    jan, feb, mar = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
    df = spark.createDataFrame([("1", jan, 1.0), ("2", jan, 3.0), ("1", feb, None), ("2", feb, 4.0), ("2", mar, 1.0)], "zip_code string, period_month date, v double")
    assert rows(joins.against_all(df, "1", "v"), "period_month", "v", "all_v") == [(jan, 1.0, 2.0)]


def test_map_features_defaults(spark):
    shapes = spark.createDataFrame([("1", "g1"), ("2", "g2"), ("3", "g3")], "zcta string, geometry string")
    known = spark.createDataFrame(
        [("1", 61.25, "Core", "High", 450000.0, 0.0), ("3", None, "Core", "Low", None, 70000.4)],
        "zip_code string, display_score double, region string, data_confidence string, median_sale_price double, median_household_income double",
    )
    got = {r["zcta"]: r for r in joins.map_features(shapes, known).collect()}
    assert (got["1"]["display_score"], got["1"]["median_sale_price"], got["1"]["median_household_income"]) == (61.3, "$450,000", "N/A")
    assert (got["2"]["display_score"], got["2"]["region"], got["2"]["data_confidence"], got["2"]["median_sale_price"]) == (50.0, "—", "—", "N/A")
    assert got["2"]["fill_color"] == got["3"]["fill_color"] == [107, 103, 86, 190]
    assert got["3"]["display_score"] is None and got["3"]["median_household_income"] == "$70,000"


def test_order_and_top(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0)], "zip_code string, v double")
    assert [r[0] for r in ordering.top_n(df, "v", 3).collect()] == ["d", "a", "b"]
    assert [r[0] for r in ordering.distinct_sorted(df.union(df), "zip_code").collect()] == list("abcd")
    assert [r[0] for r in ordering.ordered(df, ["zip_code"]).collect()] == list("abcd")
    assert "TakeOrderedAndProject" in plan(ordering.top_n(df, "v", 3))
