import gzip
import os
from datetime import date, datetime

import pytest
from conftest import page, rows

from areascore.plans import ingest
from areascore.schemas import CRIME_ATTRIBUTES, PERMIT_ATTRIBUTES, PROPERTY_ATTRIBUTES, RAW_TABLES
from areascore.sources import tables

MS = 1000


def ms(*parts):
    return int((datetime(*parts) - datetime(1970, 1, 1)).total_seconds()) * MS


@pytest.fixture
def place(tmp_path):
    """(landing folder, table folder, state path)."""
    (tmp_path / "land").mkdir()
    return str(tmp_path / "land"), str(tmp_path / "raw"), str(tmp_path / "state")


def stored(spark, place, name, *cols):
    return rows(tables.read_raw(spark, place[1], name), *cols)


# -- home values ------------------------------------------------------------------------------

WIDE = "RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName"


def wide(write, metric, months, *areas):
    lines = [f"{WIDE},{','.join(months)}"]
    lines += [f"1,0,{z},Zip,x,{state},c,m,Davidson,{','.join(values)}" for z, state, *values in areas]
    write(f"land/{metric}/file.csv", "\n".join(lines) + "\n")


def test_home_values_stage_two_areas_two_months(spark, write, tmp_path):
    wide(write, "ZHVI", ["2024-01-31", "2024-02-29"], ("37203", "TN", "1.5", "2"), ("37027", "TN", "3", ""), ("28202", "NC", "9", "9"))
    from areascore.sources.files import read_wide_csv

    df = ingest.stage_home_values(read_wide_csv(spark, str(tmp_path / "land/ZHVI")), "ZHVI", datetime(2024, 3, 1))
    assert df.columns == RAW_TABLES["home_values"].names and df.dtypes == [
        ("zip_code", "string"), ("state", "string"), ("metro", "string"), ("county_name", "string"), ("period_month", "date"),
        ("value", "double"), ("metric_type", "string"), ("ingested_at", "timestamp_ntz"),
    ]
    assert rows(df, "zip_code", "period_month", "value") == [
        ("37027", date(2024, 1, 31), 3.0), ("37203", date(2024, 1, 31), 1.5), ("37203", date(2024, 2, 29), 2.0),
    ]


def test_home_values_incremental_per_metric(spark, write, place):
    wide(write, "ZHVI", ["2024-01-31"], ("37203", "TN", "1"))
    wide(write, "ZHVF", ["2025-01-31"], ("37203", "TN", "8"))
    assert ingest.ingest_home_values(spark, *place) == 2
    assert ingest.ingest_home_values(spark, *place) == 0
    # A metric that arrives late is loaded although another one is months ahead, and does not
    # remove the other metric's rows of the same period.
    wide(write, "ZORI", ["2024-01-31", "2024-02-29"], ("37203", "TN", "5", "6"))
    assert ingest.ingest_home_values(spark, *place) == 2
    assert stored(spark, place, "home_values", "metric_type", "period_month", "value") == [
        ("ZHVF", date(2025, 1, 31), 8.0), ("ZHVI", date(2024, 1, 31), 1.0), ("ZORI", date(2024, 1, 31), 5.0),
        ("ZORI", date(2024, 2, 29), 6.0),
    ]
    assert tables.get_state(spark, place[2], "home_values/ZHVF")[0] == "2025-01-31"


def test_releases_are_read_by_their_own_headers(spark, write, place):
    head = f"{WIDE},2024-01-31,2024-02-29"
    write("land/ZHVI/2024-02.csv", f"{head}\n1,0,37203,Zip,x,TN,c,m,Davidson,1,2\n")
    write("land/ZHVI/2024-03.csv", f"{WIDE},2024-02-29,2024-03-31\n1,0,37203,Zip,x,TN,c,m,Davidson,20,3\n")
    assert ingest.ingest_home_values(spark, *place) == 3
    want = [(date(2024, 1, 31), 1.0), (date(2024, 2, 29), 20.0), (date(2024, 3, 31), 3.0)]
    assert stored(spark, place, "home_values", "period_month", "value") == want
    write("land/ZORI/x.csv", "RegionID,2024-01-31\n1,2\n")
    with pytest.raises(ValueError, match="RegionName"):
        ingest.ingest_home_values(spark, *place)


def test_the_number_of_jobs_does_not_grow_with_the_number_of_releases(spark, write, place):
    from areascore.sources.files import read_wide_csv

    used = {}
    for n in (3, 60):
        for i in range(n):
            months = ",".join(f"20{10 + (i + k) % 80:02d}-01-31" for k in range(3))
            write(f"many{n}/r{i:03d}.csv", f'{WIDE},"{months.split(",")[0]}",{",".join(months.split(",")[1:])}\n1,0,37203,Zip,x,TN,"c, d",m,Davidson,{i},{i},{i}\n')
        spark.sparkContext.setJobGroup(f"wide{n}", "wide")
        df = ingest.stage_home_values(read_wide_csv(spark, f"{os.path.dirname(place[0])}/many{n}", ["RegionName"]), "ZHVI")
        got = {r["period_month"].year: r["value"] for r in df.collect()}
        used[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"wide{n}"))
        assert got == {2010 + i + k: float(min(i + k, n - 1)) for i in range(n) for k in range(3)}
    spark.sparkContext.setJobGroup("", "")
    assert used[60] <= used[3] + 2


def test_home_values_without_the_state_is_empty(spark, write, place):
    wide(write, "ZHVI", ["2024-01-31"], ("28202", "NC", "1"), ("30301", "GA", "1"))
    assert ingest.ingest_home_values(spark, *place) == 0
    assert tables.get_state(spark, place[2], "home_values/ZHVI") == (None, None)


# -- market -----------------------------------------------------------------------------------

MARKET_COLS = ["MEDIAN_DOM", "INVENTORY", "AVG_SALE_TO_LIST", "MONTHS_OF_SUPPLY", "MEDIAN_SALE_PRICE", "HOMES_SOLD", "NEW_LISTINGS"]


def market(place, *lines):
    with gzip.open(f"{place[0]}/market.tsv.gz", "wt") as f:
        f.write("\t".join(["REGION", "STATE_CODE", "CITY", "PERIOD_END", *MARKET_COLS]) + "\n")
        f.writelines("\t".join(line) + "\n" for line in lines)


def test_market_parse_and_incremental(spark, place):
    full = ["45", "10", "0.98", "NA", "450000", "3", "2"]
    market(
        place,
        ["Zip Code: 37040", "TN", "c", "2024-03-24", *full],
        ["Zip Code: 37040", "TN", "c", "2024-03-31", *(["NA"] * 7)],
        ["37041", "TN", "c", "2024-03-31", *full],
        ["Zip Code: 10001", "NY", "c", "2024-03-31", *full],
        ["Zip Code: 37042", "TN", "c", "2024-03-31", "NA", "1", *(["NA"] * 5)],
    )
    assert ingest.ingest_market(spark, *place, etag='"v1"') == 2
    assert stored(spark, place, "market", "zip_code", "period_end", "median_dom", "inventory", "months_of_supply") == [
        ("37040", date(2024, 3, 24), 45.0, 10.0, None), ("37042", date(2024, 3, 31), None, 1.0, None),
    ]
    assert tables.get_state(spark, place[2], "market") == ("2024-03-31", '"v1"')
    assert ingest.ingest_market(spark, *place, etag='"v2"') == 0
    assert tables.get_state(spark, place[2], "market") == ("2024-03-31", '"v2"')


def test_market_files_with_another_column_order_fail_and_null_periods_are_left_out(spark, place):
    full = ["45", "10", "0.98", "NA", "450000", "3", "2"]
    market(place, ["Zip Code: 37040", "TN", "c", "", *full])
    assert ingest.ingest_market(spark, *place) == 0
    market(place, ["Zip Code: 37040", "TN", "c", "2024-03-24", *full], ["Zip Code: 37041", "TN", "c", "", *full])
    assert ingest.ingest_market(spark, *place) == 1
    with gzip.open(f"{place[0]}/zother.tsv.gz", "wt") as f:
        f.write("\t".join(["STATE_CODE", "REGION", "CITY", "PERIOD_END", *MARKET_COLS]) + "\n")
        f.write("\t".join(["TN", "Zip Code: 37042", "c", "2024-03-31", *full]) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        ingest.ingest_market(spark, *place)


def release(place, name, *lines):
    with gzip.open(f"{place[0]}/{name}.tsv.gz", "wt") as f:
        f.write("\t".join(["REGION", "STATE_CODE", "CITY", "PERIOD_END", *MARKET_COLS]) + "\n")
        f.writelines("\t".join(line) + "\n" for line in lines)


def sale(zip_code, day, dom, *rest):
    return [f"Zip Code: {zip_code}", "TN", "c", day, dom, *(rest or ["10", "0.98", "NA", "450000", "3", "2"])]


def test_of_overlapping_market_releases_the_newest_counts(spark, place):
    release(place, "2024-03", sale("37040", "2024-03-24", "1"), sale("37041", "2024-03-24", "2"), sale("37040", "2024-03-17", "3"))
    release(place, "2024-04", sale("37040", "2024-03-24", "10"), sale("37040", "2024-03-24", "11"), sale("37040", "2024-03-31", "12"))
    assert ingest.ingest_market(spark, *place) == 5
    assert stored(spark, place, "market", "zip_code", "period_end", "median_dom") == [
        ("37040", date(2024, 3, 17), 3.0), ("37040", date(2024, 3, 24), 10.0), ("37040", date(2024, 3, 24), 11.0),
        ("37040", date(2024, 3, 31), 12.0), ("37041", date(2024, 3, 24), 2.0),
    ]


def test_market_rows_that_cant_be_read_go_to_the_reject_store(spark, place):
    bad = [sale("37042", "2024-03-24", "many"), sale("37043", "24/03/2024", "4"), sale("37044", "2024-02-30", "4")]
    lines = [*bad, sale("37040", "2024-03-24", "1"), sale("37045", "2024-03-24", *(["NA"] * 7)), ["37046", *sale("1", "2024-03-24", "1")[1:]], sale("37047", "", "5")]
    release(place, "2024-03", *lines, ["Zip Code: 10001", "NY", "c", "x", *(["x"] * 7)])
    release(place, "2024-04", sale("37040", "2024-03-31", "2"))
    assert ingest.ingest_market(spark, *place) == 2
    assert [r[0] for r in stored(spark, place, "market", "zip_code")] == ["37040", "37040"]
    rejects = ingest.read_rejects(spark, place[1])
    assert rows(rejects, "rule", "REGION", "PERIOD_END", "MEDIAN_DOM", "load") == [
        ("bad_date", "Zip Code: 37043", "24/03/2024", "4", "2024-03.tsv.gz"), ("bad_date", "Zip Code: 37044", "2024-02-30", "4", "2024-03.tsv.gz"),
        ("bad_number", "Zip Code: 37042", "2024-03-24", "many", "2024-03.tsv.gz"),
    ]
    want = {"rows_in": 7, "dropped_no_area": 1, "dropped_no_measure": 1, "dropped_no_date": 1, "dropped_bad_date": 2, "dropped_bad_number": 1, "rows_kept": 1}
    losses = ingest.read_losses(spark, place[1]).filter("source = 'market'")
    count = lambda name: dict(losses.filter(f"load = '{name}'").select("rule", "n_rows").collect())
    assert count("2024-03.tsv.gz") == want and count("2024-04.tsv.gz")["rows_kept"] == 1
    # the release comes again, mended: its rejects and losses are replaced
    release(place, "2024-03", *lines[1:])
    ingest.ingest_market(spark, *place)
    assert ingest.read_rejects(spark, place[1]).count() == 2
    losses = ingest.read_losses(spark, place[1])
    assert count("2024-03.tsv.gz")["dropped_bad_number"] == 0 and losses.count() == 14
    release(place, "2024-03", lines[3])
    ingest.ingest_market(spark, *place)
    assert ingest.read_rejects(spark, place[1]).count() == 0


@pytest.mark.parametrize("files", [1, 8])
def test_market_files_of_equal_size_are_typed_where_they_are_read(spark, place, monkeypatch, files):
    spreads = []
    monkeypatch.setattr(ingest, "spread", lambda df: spreads.append(1) or df)
    for i in range(files):
        release(place, f"r{i}", sale("37040", f"2024-03-0{i + 1}", "1"), sale("37041", "2024-03-24", "many"))
    assert ingest.ingest_market(spark, *place) == files
    assert ingest.read_rejects(spark, place[1]).count() == files
    assert len(spreads) == (files == 1)


def test_market_releases_are_read_once(spark, place, monkeypatch):
    parsed = []
    landed = ingest.landed
    monkeypatch.setattr(ingest, "landed", lambda df, *a: parsed.append(df.select("load").distinct().count()) or landed(df, *a))
    release(place, "2024-03", sale("37040", "2024-03-24", "1"), sale("37041", "2024-03-24", "many"))
    assert ingest.ingest_market(spark, *place) == 1
    assert ingest.ingest_market(spark, *place, etag="e") == 0
    assert tables.get_state(spark, place[2], "market") == ("2024-03-24", "e")
    release(place, "2024-04", sale("37040", "2024-03-24", "2"), sale("37040", "2024-03-31", "3"))
    assert ingest.ingest_market(spark, *place) == 1
    assert parsed == [1, 1]
    assert stored(spark, place, "market", "period_end", "median_dom") == [(date(2024, 3, 24), 1.0), (date(2024, 3, 31), 3.0)]
    assert ingest.read_rejects(spark, place[1]).count() == 1 and ingest.read_losses(spark, place[1]).count() == 14
    # without its state the table is loaded anew from all releases
    args = place[0], place[1], f"{place[2]}-new"
    assert ingest.ingest_market(spark, *args) == 2 and parsed == [1, 1, 2]


def test_market_without_the_state_is_empty(spark, place):
    market(place, ["Zip Code: 10001", "NY", "c", "2024-03-31", *(["1"] * 7)])
    assert ingest.ingest_market(spark, *place) == 0


# -- census -----------------------------------------------------------------------------------

ZIP_HEAD = ["NAME", "B19013_001E", "B17001_002E", "B01003_001E", "zip code tabulation area"]
COUNTY_HEAD = ["NAME", "B19013_001E", "B17001_002E", "B01003_001E", "state", "county"]


def census(write, year, *areas):
    write(f"land/zip/vintage={year}/r.json", [ZIP_HEAD, *([f"ZCTA5 {a[-1]}", *a] for a in areas)])
    write(f"land/county/vintage={year}/r.json", [COUNTY_HEAD, ["Davidson County", "70000", "-666666666", "700000", "47", "037"]])


def test_census(spark, write, place):
    edge = [("1", "2", "3", z) for z in ("37000", "38599", "36999", "38600", "abcde")]
    census(write, 2022, ("65000", "500", "10000", "37203"), ("-666666666", "300", "-666666666", "37027"), *edge)
    assert ingest.ingest_census(spark, *place) == {"zip": 4, "county": 1}
    assert stored(spark, place, "census_zip", "zcta", "state_fips", "median_household_income", "total_population", "vintage_year") == [
        ("37000", "47", 1.0, 3.0, 2022), ("37027", "47", None, None, 2022), ("37203", "47", 65000.0, 10000.0, 2022),
        ("38599", "47", 1.0, 3.0, 2022),
    ]
    assert stored(spark, place, "census_county", "county_fips", "county_name", "state_fips", "poverty_count") == [
        ("47037", "Davidson County", "47", None)
    ]
    assert tables.get_state(spark, place[2], "census/zip")[0] == "2022"
    assert ingest.ingest_census(spark, *place) == {"zip": 0, "county": 0}
    census(write, 2024, ("1", "1", "1", "37203"))
    assert ingest.ingest_census(spark, *place) == {"zip": 1, "county": 1}
    assert len(stored(spark, place, "census_zip")) == 5
    assert tables.get_state(spark, place[2], "census/county")[0] == "2024"


def test_a_crash_leaves_no_vintage_half_loaded(spark, write, place, monkeypatch):
    census(write, 2022, ("1", "1", "1", "37203"))
    ingest.ingest_census(spark, *place)
    census(write, 2023, ("2", "2", "2", "37203"))
    census(write, 2024, ("3", "3", "3", "37203"))
    for step in ("write_manifest", "_measured"):
        with monkeypatch.context() as m:
            m.setattr(tables, step, lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                ingest.ingest_census(spark, *place)
        assert stored(spark, place, "census_zip", "vintage_year") == [(2022,)]
    assert ingest.ingest_census(spark, *place) == {"zip": 2, "county": 2}
    assert stored(spark, place, "census_zip", "vintage_year", "poverty_count") == [(2022, 1.0), (2023, 2.0), (2024, 3.0)]


def test_census_parts_land_apart_and_later_years_load(spark, write, place):
    census(write, 2023, ("1", "1", "1", "37203"))
    os.rename(f"{place[0]}/zip", f"{place[0]}/zip-later")
    assert ingest.ingest_census(spark, *place) == {"zip": 0, "county": 1}
    os.rename(f"{place[0]}/zip-later", f"{place[0]}/zip")
    assert ingest.ingest_census(spark, *place) == {"zip": 1, "county": 0}
    census(write, 2031, ("2", "2", "2", "37203"))
    assert ingest.ingest_census(spark, *place) == {"zip": 1, "county": 1}
    assert stored(spark, place, "census_zip", "vintage_year") == [(2023,), (2031,)]


# -- crime ------------------------------------------------------------------------------------


def incident(when, zip_code="37213.0", kind="THEFT"):
    return {"Incident_Occurred": when, "Offense_Description": kind, "ZIP_Code": zip_code}


def test_crime_stage_rules(spark):
    raw = spark.createDataFrame(
        [(1672531200000.0, "THEFT", "37213.0"), (1672531200000.0, None, "37013"), (1.0, "x", None), (1.0, "x", ""),
         (1.0, "x", "UNK"), (None, "x", "37213.0")],
        CRIME_ATTRIBUTES,
    )
    out = ingest.stage_crime(raw)
    assert out.columns == RAW_TABLES["crime"].names
    assert rows(out, "incident_occurred", "incident_type", "zip_code") == [
        (datetime(2023, 1, 1), "THEFT", "37213"), (datetime(2023, 1, 1), None, "37013"),
    ]
    assert ingest.stage_crime(raw.filter("ZIP_Code = 'UNK'")).count() == 0


def fetch(write, name, *pages, complete=True):
    """A landed fetch: its pages, and the marker with their number."""
    for i, content in enumerate(pages):
        write(f"land/load={name}/p{i}.json", content)
    if complete:
        write(f"land/load={name}/complete", f"{len(pages)}\n")


def crimes(spark, place):
    return sorted((r[0], r[1]) for r in stored(spark, place, "crime", "incident_occurred", "incident_type"))


def test_crime_lookback_and_replay(spark, write, place):
    fetch(write, "01", page(incident(ms(2024, 1, 5)), incident(ms(2024, 3, 1, 10))), page(incident(ms(2024, 2, 20)), incident(ms(2024, 2, 21), "UNK")))
    assert ingest.ingest_crime(spark, *place) == 3
    assert tables.get_state(spark, place[2], "crime")[0] == "2024-03-01T10:00:00"
    first = crimes(spark, place)
    assert ingest.ingest_crime(spark, *place) == 0 and crimes(spark, place) == first
    # A late record inside the lookback arrives once, one before it does not.
    again = [incident(ms(2024, 2, 20)), incident(ms(2024, 3, 1, 10))]
    fetch(write, "02", page(*again, incident(ms(2024, 2, 10), kind="LATE"), incident(ms(2024, 1, 6), kind="TOO LATE")))
    assert ingest.ingest_crime(spark, *place) == 3
    want = [(datetime(2024, 1, 5), "THEFT"), (datetime(2024, 2, 10), "LATE"), (datetime(2024, 2, 20), "THEFT"), (datetime(2024, 3, 1, 10), "THEFT")]
    assert crimes(spark, place) == want


def test_lost_rows_are_counted_by_rule(spark, write, place):
    fetch(write, "01", page(incident(ms(2024, 3, 1)), incident(ms(2024, 3, 2), ""), incident(ms(2024, 3, 2), "UNK"), incident(None)))
    assert ingest.ingest_crime(spark, *place) == 1
    losses = spark.read.parquet(f"{place[1]}/_losses").filter("source = 'crime'")
    assert dict(losses.select("rule", "n_rows").collect()) == {
        "rows_in": 4, "dropped_blank_area": 1, "dropped_bad_area": 1, "dropped_no_time": 1, "rows_kept": 1,
    }


def test_pages_are_parsed_once(spark, write, place, monkeypatch):
    fetch(write, "01", page(incident(ms(2024, 3, 1)), incident(None)), {"features": []})
    scans = []
    read = ingest._read_json
    monkeypatch.setattr(ingest, "_read_json", lambda *a: scans.append(1) or read(*a))
    land = ingest.landed

    def once(*args):
        rows, folder = land(*args)
        for name in os.listdir(f"{place[0]}/load=01"):
            os.rename(f"{place[0]}/load=01/{name}", f"{place[0]}/load=01/{name}.gone")
        return rows, folder

    monkeypatch.setattr(ingest, "landed", once)
    assert ingest.ingest_crime(spark, *place) == 1 and scans == [1]
    assert os.listdir(f"{place[1]}/_landed/crime") == []


@pytest.mark.parametrize("step", ["maintain", "record_losses", "write_replace_from"])
def test_losses_count_once_after_a_crash(spark, write, place, monkeypatch, step):
    fetch(write, "01", page(incident(ms(2024, 3, 1)), incident(None)))
    fetch(write, "02", page(incident(ms(2024, 3, 4), "UNK"), incident(ms(2024, 3, 5))))
    with monkeypatch.context() as m:
        m.setattr(ingest, step, lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.ingest_crime(spark, *place)
    ingest.ingest_crime(spark, *place)
    found = ingest.read_losses(spark, place[1]).groupBy("load", "rule").sum("n_rows").collect()
    counts = {(r[0], r[1]): r[2] for r in found}
    assert len(counts) == 10 and counts["01", "dropped_no_time"] == counts["02", "dropped_bad_area"] == 1
    assert counts["01", "rows_kept"] == counts["02", "rows_kept"] == 1 and counts["02", "rows_in"] == 2
    assert [r[0].day for r in crimes(spark, place)] == [5]


def test_only_new_fetches_come_to_the_driver(spark, write, place):
    log = f"{place[1]}/_applied/crime"
    spark.range(5000).selectExpr("lpad(id, 6, '0') load").write.parquet(log)
    given = spark.range(4990, 5003).selectExpr("lpad(id, 6, '0') load", "cast(1 as int) pages")
    assert ingest.new_fetches(given, log) == [("005000", 1), ("005001", 1), ("005002", 1)]


def test_what_loads_leave_behind_stays_bounded(spark, write, place, monkeypatch):
    monkeypatch.setattr(ingest, "GRACE", 0.0)
    keep_house = ingest.maintain
    monkeypatch.setattr(ingest, "maintain", lambda s, t, source: keep_house(s, t, source, 0.0))
    fold = tables.fold_log
    monkeypatch.setattr(tables, "fold_log", lambda *a, **k: fold(*a, **{**k, "most": 3, "grace": 0.0}))
    monkeypatch.setattr(ingest, "fold_log", tables.fold_log)
    for i in range(10):
        fetch(write, f"{i:02d}", page(*(incident(ms(2024, 3, 1 + k), kind=f"f{i}") for k in range(i + 1))))
        ingest.ingest_crime(spark, *place)
    count = lambda path, end: sum(f.endswith(end) for _, _, names in os.walk(path) for f in names)
    assert count(place[2], ".parquet") <= 5 and count(f"{place[1]}/_applied/crime", ".parquet") <= 5
    assert len([f for f in os.listdir(f"{place[1]}/crime/_manifests") if f.isdigit()]) <= 3
    assert len(os.listdir(f"{place[1]}/crime/part_month=2024-03-01")) <= 3
    assert crimes(spark, place) == [(datetime(2024, 3, 1 + k), "f9") for k in range(10)]
    assert tables.get_state(spark, place[2], "crime")[0] == "2024-03-10T00:00:00"
    assert ingest.ingest_crime(spark, *place) == 0


def test_overlapping_fetches_store_each_incident_once(spark, write, place):
    two = [incident(ms(2024, 3, 1)), incident(ms(2024, 3, 2))]
    fetch(write, "01", page(*two))
    fetch(write, "02", page(*two, incident(ms(2024, 3, 5))))
    assert ingest.ingest_crime(spark, *place) == 3
    assert [r[0].day for r in crimes(spark, place)] == [1, 2, 5]


def test_a_fetch_counts_when_it_is_complete(spark, write, place):
    fetch(write, "01", page(incident(ms(2024, 3, 1)), incident(ms(2024, 3, 2))), complete=False)
    assert ingest.ingest_crime(spark, *place) == 0
    write("land/load=01/p1.json", page(incident(ms(2024, 3, 5))))
    write("land/load=01/complete", "3")
    with pytest.raises(ValueError, match="2 of 3 pages"):
        ingest.ingest_crime(spark, *place)
    write("land/load=01/complete", "2")
    assert ingest.ingest_crime(spark, *place) == 3
    assert [r[0].day for r in crimes(spark, place)] == [1, 2, 5]


def test_many_fetches_equal_the_runs_they_stand_for(spark, write, place, monkeypatch):
    days = [(2024, 1, 1 + i) for i in range(24)]
    for i in range(8):
        fetch(write, f"{i:03d}", page(*(incident(ms(*d), kind=f"f{i}") for d in days[max(0, 3 * i - 2) : 3 * i + 3])))
    monkeypatch.setitem(ingest.fixed.LOOKBACK, "crime", (2, "2010-01-01T00:00:00"))
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("many"))
    spark.sparkContext.setJobGroup("many", "many")
    ingest.ingest_crime(spark, *place)
    used = jobs()
    spark.sparkContext.setJobGroup("one", "one")
    apart = (place[0], f"{place[1]}-apart", f"{place[2]}-apart")
    for i in range(8):
        ingest.ingest_feed(spark, "crime", *apart, fetches=[(f"{i:03d}", 1)])
    assert crimes(spark, place) == crimes(spark, apart) and used < 40
    assert tables.get_state(spark, place[2], "crime")[0] == tables.get_state(spark, apart[2], "crime")[0]


@pytest.mark.parametrize("step", ["write_manifest", "set_state"])
def test_a_crash_leaves_the_old_table_and_a_rerun_mends_it(spark, write, place, monkeypatch, step):
    fetch(write, "01", page(incident(ms(2024, 2, 10)), incident(ms(2024, 3, 2))))
    assert ingest.ingest_crime(spark, *place) == 2
    before = crimes(spark, place)
    fetch(write, "02", page(incident(ms(2024, 2, 10)), incident(ms(2024, 3, 2)), incident(ms(2024, 3, 9))))
    with monkeypatch.context() as m:
        m.setattr(tables if step == "write_manifest" else ingest, step, lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.ingest_crime(spark, *place)
    assert crimes(spark, place) == before or step == "set_state"
    assert ingest.ingest_crime(spark, *place) == 3
    assert [r[0].day for r in crimes(spark, place)] == [10, 2, 9]


def test_crime_error_page_changes_nothing(spark, write, place):
    fetch(write, "01", page(incident(ms(2024, 1, 5))), {"error": {"code": 429}})
    with pytest.raises(ValueError, match="error"):
        ingest.ingest_crime(spark, *place)
    assert tables.get_state(spark, place[2], "crime") == (None, None)


def test_crime_empty_pages(spark, write, place):
    fetch(write, "01", {"features": []})
    assert ingest.ingest_crime(spark, *place) == 0


# -- permits, rates, property -----------------------------------------------------------------


def test_permits(spark, write, place):
    base = {"Permit_Type_Description": "New Construction", "ZIP": "37203"}
    raw = [
        {**base, "Permit__": "P001", "Date_Issued": 1672574400000, "Const_Cost": 500000.0},
        {**base, "Permit__": "P002", "Date_Issued": 1672574400000, "Const_Cost": None},
        {**base, "Permit__": "P003", "Date_Issued": None, "Const_Cost": 1},
        {**base, "Permit__": "P004", "Date_Issued": 1672574400000, "Const_Cost": "about 5"},
    ]
    fetch(write, "1", page(*raw))
    assert ingest.ingest_permits(spark, *place) == 3
    six = datetime(2023, 1, 1, 6)
    assert stored(spark, place, "permits", "permit_number", "date_issued", "construction_cost") == [
        ("P001", six, 500000.0), ("P002", six, None), ("P004", six, None),
    ]
    assert tables.get_state(spark, place[2], "permits")[0] == "2023-01-01T06:00:00"
    none = spark.createDataFrame([("P", "t", None, "z", None)], PERMIT_ATTRIBUTES)
    assert ingest.stage_permits(none).count() == 0


def test_rates(spark, write, place):
    obs = [("2024-01-04", "6.62"), ("2024-01-11", "."), ("2024-01-18", "6.59")]
    fetch(write, "1", {"observations": [{"date": d, "value": v} for d, v in obs]})
    assert ingest.ingest_rates(spark, *place) == 2
    assert stored(spark, place, "rates", "observation_date", "rate", "series_id") == [
        (date(2024, 1, 18), 6.59, "MORTGAGE30US"), (date(2024, 1, 4), 6.62, "MORTGAGE30US"),
    ]
    fetch(write, "2", {"observations": [{"date": d, "value": v} for d, v in (("2024-01-18", "6.59"), ("2024-01-25", "6.69"))]})
    assert ingest.ingest_rates(spark, *place) == 2  # the stored date again, and the new one
    assert [r[0].day for r in stored(spark, place, "rates", "observation_date")] == [18, 25, 4]
    assert tables.get_state(spark, place[2], "rates")[0] == "2024-01-25"


def test_rates_empty(spark, write, place):
    fetch(write, "1", {"observations": []})
    assert ingest.ingest_rates(spark, *place) == 0


def test_property(spark, write, place):
    sale = {"APN": "a1", "PropZip": 37203, "LUCode": 11, "LUDesc": "SINGLE", "SalePrice": 1, "OwnDate": ms(2024, 3, 15, 13), "ValidSale": "Y", "TotlAppr": 2, "TotlAssd": 3.5}
    fetch(write, "1", page(sale, {**sale, "APN": "a2", "SalePrice": None}, {**sale, "APN": "a3", "OwnDate": None}, {**sale, "APN": "a4", "ValidSale": "N"}))
    assert ingest.ingest_property(spark, *place) == 2
    assert stored(spark, place, "property", "apn", "prop_zip", "lu_code", "sale_price", "own_date", "totl_assd") == [
        ("a1", "37203", "11", 1.0, date(2024, 3, 15), 3.5), ("a2", "37203", "11", None, date(2024, 3, 15), 3.5),
    ]
    assert tables.get_state(spark, place[2], "property")[0] == "2024-03-15"
    assert ingest.stage_property(spark.createDataFrame([], PROPERTY_ATTRIBUTES)).columns == RAW_TABLES["property"].names
