from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from areascore.functions.fixed_values import FRESHNESS_LIMITS
from areascore.operators import checks
from areascore.plans import contracts, marts, models, reports, seeds, staging
from areascore.schemas import RAW_TABLES, SEED_REGIONS, SEED_VALID
from areascore.sources.files import read_relationship

NOW = datetime(2024, 3, 1, 6)
AREAS = ["37201", "37202", "37203", "37204"]  # complete, no market, no crime, neither


@pytest.fixture(scope="module")
def raw(spark):
    def table(name, *data):
        return spark.createDataFrame([(*row, NOW) for row in data], RAW_TABLES[name])

    def market(z, day, dom, price, sold):
        return (z, "TN", day, dom, 10.0, 0.98, None, price, sold, 4.0)

    jan, feb = date(2024, 1, 28), date(2024, 2, 25)
    return {
        "home_values": table(
            "home_values",
            ("37201", "TN", "m", "c", date(2024, 1, 31), 400000.0, "ZHVI"),
            ("37201", "TN", "m", "c", date(2024, 2, 29), 410000.0, "ZHVI"),
            ("37201", "TN", "m", "c", date(2024, 2, 29), None, "ZORI"),
            ("10001", "NY", "m", "c", date(2024, 2, 29), 1.0, "ZHVI"),
        ),
        "market": table(
            "market",
            market("37201", jan, 10.0, 300000.0, 4.0),
            market("37201", date(2024, 1, 7), 20.0, 320000.0, 6.0),
            market("37201", feb, 30.0, 400000.0, 8.0),
            market("37203", jan, 50.0, 200000.0, 0.0),
            market("10001", feb, 1.0, 1.0, 1.0),
        ),
        "census_zip": table(
            "census_zip",
            *((z, "47", 50000.0 + 10000 * i, 100.0 * i, 1000.0, 2023) for i, z in enumerate(AREAS)),
            ("37201", "47", 1.0, 1.0, 1.0, 2022),
            ("37205", "47", None, 5.0, 0.0, 2023),
        ),
        "census_county": table("census_county", ("47037", "Davidson County", "47", 1.0, 2.0, 3.0, 2023)),
        "crime": table(
            "crime",
            *((datetime(2024, 1, d), "THEFT", "37201") for d in range(1, 6)),
            *((datetime(2024, 1, d), "POLICE INQUIRY", "37201") for d in range(1, 20)),
            (datetime(2023, 5, 5), "ROBBERY", "37201"),
            (datetime(2024, 1, 2), None, "37202"),
            (datetime(2024, 1, 2), "THEFT", "10001"),
        ),
        "permits": table(
            "permits",
            ("P1", "New", datetime(2024, 1, 1), "37201", 5.0),
            ("P1", "New", datetime(2024, 2, 1), "99999", 7.0),
            ("P2", "New", datetime(2024, 1, 1), "37201", None),
            ("P2", "Old", datetime(2023, 1, 1), "37201", 1.0),
            ("P3", "New", datetime(2024, 1, 1), "37203", None),
        ),
        "rates": table(
            "rates", (date(2024, 1, 4), 6.62, "MORTGAGE30US"), (date(2024, 1, 4), 6.62, "MORTGAGE30US"),
            (date(2024, 1, 11), 6.66, "MORTGAGE30US"), (date(2024, 2, 1), 7.0, "MORTGAGE30US"),
        ),
        "property": table("property"),
    }


@pytest.fixture(scope="module")
def lists(spark):
    valid = spark.createDataFrame([(z,) for z in [*AREAS, "37205"]], SEED_VALID)
    regions = spark.createDataFrame(
        [(z, "Core" if i < 2 else "West", "Davidson", "47037") for i, z in enumerate([*AREAS, "37205"])], SEED_REGIONS
    )
    return valid, regions


@pytest.fixture(scope="module")
def built(raw, lists):
    return models.run_models(raw, *lists)


def test_staging(built):
    assert rows(built["stg_home_values"], "zip_code", "value") == [("37201", 400000.0), ("37201", 410000.0)]
    assert rows(built["stg_crime"].groupBy("crime_category").count()) == [
        ("Administrative", 19), ("Other", 1), ("Property", 5), ("Violent", 1),
    ]
    assert rows(built["stg_rates"], "observation_date", "rate") == [
        (date(2024, 1, 11), 6.66), (date(2024, 1, 4), 6.62), (date(2024, 2, 1), 7.0),
    ]
    assert all("ingested_at" not in built[n].columns for n in built)


def test_permit_outside_the_areas_keeps_its_older_record(built):
    assert rows(built["stg_permits"], "permit_number", "permit_type", "zip_code") == [
        ("P1", "New", "37201"), ("P2", "New", "37201"), ("P3", "New", "37203"),
    ]


def test_intermediate(built):
    assert rows(built["crime_index"], "zip_code", "incident_year", "incident_count", "incidents_per_1k") == [
        ("37201", 2023, 1, 1.0), ("37201", 2024, 5, 5.0), ("37202", 2024, 1, 1.0),
    ]
    assert ("37201", 2024, "Property", 5) in rows(built["crime_by_category"], "zip_code", "incident_year", "crime_category", "incident_count")
    assert rows(built["permit_activity"]) == [("37201", 2024, 2, 5.0), ("37203", 2024, 1, None)]
    poverty = dict(rows(built["zip_demographics"], "zip_code", "poverty_rate"))
    assert poverty["37202"] == 0.1 and poverty["37205"] is None


def test_monthly_fact(built):
    got = rows(
        built["monthly_fact"], "zip_code", "period_month", "median_dom", "median_sale_price", "week_count",
        "computed_months_of_supply", "zhvi", "zori", "avg_mortgage_rate",
    )
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    assert got == [
        ("37201", jan, 15.0, 310000.0, 2, 2.0, 400000.0, None, 6.64),
        ("37201", feb, 30.0, 400000.0, 1, 1.25, 410000.0, None, 7.0),
        ("37203", jan, 50.0, 200000.0, 1, None, None, None, 6.64),
    ]


def test_score_labels_and_imputation(built):
    got = {r["zip_code"]: r for r in built["opportunity_score"].collect()}
    assert [got[z]["data_confidence"] for z in AREAS] == ["High", "Partial", "Partial", "Low"]
    assert got["37201"]["affordability_score"] == 0.0 and got["37203"]["affordability_score"] == 100.0
    assert got["37202"]["affordability_score"] is None
    # Rates 5.0 and 1.0: mean 3.0, minimum with gaps as 0 is 0, spread 4.0.
    assert [got[z]["safety_score"] for z in AREAS] == [-25.0, 75.0, 25.0, 25.0]
    # Permits 2 and 1: mean 1.5.
    assert [got[z]["permit_score"] for z in AREAS] == [100.0, 50.0, 0.0, 50.0]
    assert got["37204"]["income_score"] == 100.0 and got["37205"]["income_score"] is None
    known = [got["37204"][f"{n}_score"] for n in ("income", "poverty", "safety", "permit")]
    assert got["37204"]["opportunity_score"] == pytest.approx(round((150 + sum(known)) / 7, 2), abs=0.006)
    assert all(0 <= r["opportunity_score"] <= 100 for r in got.values())


def score_of(spark, values, col="incidents_per_1k"):
    data = [(str(i), *([1.0] * 4), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "zip_code string, median_sale_price double, median_dom double, poverty_rate double, permit_count double, incidents_per_1k double")
    full = df.withColumns({c: F.lit(None).cast("string") for c in marts.SCORE_COLUMNS if c not in df.columns}).withColumns(
        {c: F.lit(1.0) for c in ("median_homes_sold", "median_household_income")}
    )
    return {r["zip_code"]: r for r in marts.score_areas(full).collect()}


def test_worst_area_can_fall_below_zero(spark):
    got = score_of(spark, [100.0, 2.0, None])
    assert got["0"]["safety_score"] == -2.04
    assert got["0"]["affordability_score"] is None  # one value only, no spread
    assert score_of(spark, [100.0, 2.0])["0"]["safety_score"] == 0.0


def test_declared_checks_pass_and_count(built):
    results = contracts.check_models(built)
    summary = checks.summarise_checks(results).head()
    failed = [r for r in results.collect() if r["status"] != "pass"]
    assert (summary["tests_run"], failed, summary["tests_passed"]) == (61, [], 61)


def test_run_and_check_writes_tables_and_audit(spark, raw, lists, tmp_path):
    audit = str(tmp_path / "audit")
    out = models.run_and_check(spark, raw, *lists, audit, datetime(2024, 3, 3, 18))
    assert (out["status"], out["tests_run"], out["tests_passed"]) == ("success", 61, 61)
    assert spark.table("marts.opportunity_score").count() == 5
    assert spark.table("intermediate.crime_index").count() == 3
    page = reports.health_page(spark.read.parquet(audit))
    assert rows(page["last"]) == [("2024-03-03 18:00", "daily", "SUCCESS", "61/61")]
    shown = dict(rows(page["freshness"], "source", "shown"))
    assert shown["crime"] == "⚠️ warn" and shown["market"] == "✅ pass" and shown["property"] == "N/A"


def test_failing_checks_are_reported(spark, lists):
    df = spark.createDataFrame([("1", 5.0, "a"), ("1", -1.0, "b"), (None, None, None)], "k string, v double, c string")
    results = checks.run_checks("t", df, ["k", "v"], ["k"], {"c": ["a"]}, [["k", "v"]], {"v": (0, 100)}, {"v": 0})
    assert {r["check"]: r["violations"] for r in results.collect()} == {
        "t.k not null": 1, "t.v not null": 1, "t.c accepted": 1, "t.v range": 1, "t.v null budget": 1, "t.k unique": 1,
        "t.k+v grain": 0,
    }
    assert rows(checks.check_null_budget(df, "v", 0)) == [(1,)] and rows(checks.check_null_budget(df, "v", 1)) == []


@pytest.mark.parametrize("age, status", [(1, "pass"), (2, "pass"), (2.5, "warn"), (4, "error")])
def test_freshness(spark, age, status):
    from datetime import timedelta

    df = spark.createDataFrame([(NOW,), (datetime(2020, 1, 1),)], "ingested_at timestamp_ntz")
    got = checks.check_freshness(df, "ingested_at", 2, 3, NOW + timedelta(days=age)).head()
    assert (got["status"], got["age_days"], got["latest"]) == (status, age, NOW)
    assert checks.check_freshness(df.limit(0), "ingested_at", 2, 3, NOW).head()["status"] == "error"


def test_source_freshness_covers_all_sources(raw):
    got = {r["source"]: r["status"] for r in contracts.check_sources(raw, NOW).collect()}
    assert got == dict.fromkeys(FRESHNESS_LIMITS, "pass")


def test_coverage(spark):
    expected = spark.createDataFrame([(str(i),) for i in range(10)], "z string")
    assert rows(checks.check_coverage(expected.limit(9), expected, "z")) == []
    assert rows(checks.check_coverage(expected.limit(8), expected, "z")) == [(10, 2, "warn")]


def test_build_seeds(spark, write):
    path = write(
        "rel.txt",
        "GEOID_ZCTA5_20|GEOID_COUNTY_20|AREALAND_PART\n"
        "37013|47037|10\n37013|47149|30\n"  # larger overlap wins
        "37201|47187|5\n37201|47037|5\n"  # equal overlap: lower county code
        " 37205 | 47037 |\n"  # padded, blank overlap
        "37998|47037|1\n37046|47187|9\n"
        "37040|47125|99\n|47125|1\n",  # other county
    )
    valid, regions = seeds.build_seeds(read_relationship(spark, path))
    assert [r[0] for r in valid.collect()] == ["37013", "37046", "37201", "37205", "37998"]
    assert rows(regions) == [
        ("37013", "Rutherford County", "Rutherford", "47149"),
        ("37046", "Williamson County", "Williamson", "47187"),
        ("37201", "Urban Core", "Davidson", "47037"),
        ("37205", "West Nashville", "Davidson", "47037"),
        ("37998", "Davidson Other", "Davidson", "47037"),
    ]
    assert rows(seeds.areas_per_county(regions)) == [("Davidson", 3), ("Rutherford", 1), ("Williamson", 1)]


def test_pages(spark, built, lists):
    monthly, scores = built["monthly_fact"], built["opportunity_score"]
    shapes = spark.createDataFrame([("37201", "g"), ("39999", "g")], "zcta string, geometry string")
    page = reports.map_page(scores, shapes)
    assert page["table"].count() == 5 and page["features"].count() == 2
    table = page["table"].collect()
    known = [r["display_score"] for r in table if r["display_score"] is not None]
    assert known == sorted(known, reverse=True) and table[-1]["display_score"] is None
    (top,) = page["top"].collect()
    (figures,) = page["kpis"].collect()
    assert (figures["top_zip"], figures["top_score"]) == (top["zip_code"], top["display_score"]) == ("37201", max(known))
    unscored = reports.map_page(scores.withColumn("activity_score", F.lit(None).cast("double")))["kpis"]
    assert unscored.select("top_zip", "top_score").first() == (None, None)
    # Equal weights repeat the mart score where every signal is known.
    whole = {r["zip_code"]: r["opportunity_score"] for r in scores.collect()}
    assert whole["37201"] == top["display_score"]

    page = reports.affordability_page(monthly, scores, "37201")
    assert rows(page["latest"]) == [(410000.0, 7.0)]
    assert rows(page["kpis"]) == [(300000.0, 65000.0)]
    assert [r["region"] for r in page["region_prices"].collect()] == ["Core", "West"]
    assert page["area"].count() == 2 and page["value_trend"].count() == 2 and page["rate_trend"].count() == 2

    page = reports.inventory_page(monthly, "37201")
    assert rows(page["kpis"]) == [(10.0, 1.25, 4.0)]
    assert page["area_supply"].count() == 2 and page["supply_trend"].count() == 2

    page = reports.crime_page(scores, built["crime_index"], built["crime_by_category"])
    assert rows(page["kpis"]) == [(3.0, "37202", "37201")]
    assert rows(page["trend"]) == [(2023, 1.0), (2024, 3.0)]
    assert [r["zip_code"] for r in page["areas"].collect()] == ["37201", "37202"]
    assert rows(page["regions"]) == [("Core", 3.0)]
    violent = reports.crime_page(scores, built["crime_index"], built["crime_by_category"], "Violent")
    assert rows(violent["category_rates"], "zip_code", "incident_year", "incident_count") == [("37201", 2023, 1)]

    page = reports.momentum_page(monthly, "37203")
    assert rows(page["kpis"]) == [(40.0, 0.98, 300000.0)]
    assert rows(page["area"]) == [(date(2024, 1, 1), 50.0, 32.5)]

    page = reports.transactions_page(monthly, scores, "37201")
    assert rows(page["kpis"]) == [(4.0, 1.5, "37201")]
    assert [tuple(r) for r in page["permits"].collect()] == [("37201", "Core", 2), ("37203", "West", 1)]
    assert page["area"].count() == 2
    assert [r[0] for r in reports.area_list(monthly).collect()] == ["37201", "37203"]


def test_census_staging_keeps_all_vintages(raw, lists):
    assert staging.stg_census_zip(raw["census_zip"], lists[0]).filter("zip_code = '37201'").count() == 2
