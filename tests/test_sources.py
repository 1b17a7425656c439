import gzip
from datetime import date

import pytest
from conftest import page, rows
from pyspark.errors import PySparkException

from areascore.schemas import CRIME_ATTRIBUTES, PROPERTY_ATTRIBUTES, SEED_COVERAGE, SEED_REGIONS
from areascore.sources import files

MARKET_HEADER = "PERIOD_END\tREGION\tSTATE_CODE\tEXTRA\tMEDIAN_DOM"


def test_market_tsv_reads_gzip_as_text(spark, tmp_path):
    path = tmp_path / "market.tsv.gz"
    with gzip.open(path, "wt") as f:
        f.write(f"{MARKET_HEADER}\n2024-03-31\tZip Code: 37040\tTN\tx\tNA\n2024-03-31\tZip Code: 10001\tNY\ty\t45\n")
    df = files.read_market_tsv(spark, str(path))
    assert {kind for _, kind in df.dtypes} == {"string"}
    assert rows(df, "REGION", "MEDIAN_DOM") == [("Zip Code: 10001", "45"), ("Zip Code: 37040", "NA")]
    assert files.spread(df).rdd.getNumPartitions() == 4


def test_market_tsv_short_and_long_lines_keep_known_columns(spark, write):
    path = write("m.tsv", f"{MARKET_HEADER}\n2024-03-31\tZip Code: 1\tTN\n2024-03-31\tZip Code: 2\tTN\tx\t4\tmore\n")
    assert rows(files.read_market_tsv(spark, path), "REGION", "MEDIAN_DOM") == [("Zip Code: 1", None), ("Zip Code: 2", "4")]


def test_header_matrix_picks_by_name_and_takes_partition_folders(spark, write, tmp_path):
    body = [["NAME", "B01003_001E", "zip code tabulation area"], ["ZCTA5 37203", "10000", "37203"]]
    swapped = [["zip code tabulation area", "NAME", "B01003_001E"], ["37027", "ZCTA5 37027", None]]
    write("zip/vintage=2022/a.json", body)
    write("zip/vintage=2023/a.json", swapped)
    df = files.read_header_matrix(spark, str(tmp_path / "zip"), ["zip code tabulation area", "B01003_001E"])
    assert rows(df) == [("37027", None, 2023), ("37203", "10000", 2022)]


def test_header_matrix_header_only_is_empty(spark, write):
    assert rows(files.read_header_matrix(spark, write("a.json", [["NAME"]]), ["NAME"])) == []


def test_header_matrix_missing_column_fails(spark, write):
    df = files.read_header_matrix(spark, write("a.json", [["NAME"], ["x"]]), ["county"])
    with pytest.raises(PySparkException, match="no column"):
        df.collect()


def test_observations(spark, write, tmp_path):
    write("r/a.json", {"count": 2, "observations": [{"date": "2024-01-04", "value": "6.62"}, {"date": "2024-01-11", "value": "."}]})
    write("r/b.json", {"observations": []})
    assert rows(files.read_observations(spark, str(tmp_path / "r"))) == [("2024-01-04", "6.62"), ("2024-01-11", ".")]


def test_feature_pages_concatenate_and_empty_page_gives_no_rows(spark, write, tmp_path):
    write("c/p1.json", page({"Incident_Occurred": 1672531200000, "Offense_Description": "THEFT", "ZIP_Code": "37213.0"}))
    write("c/p2.json", page({"Incident_Occurred": 1672531200000.0, "Offense_Description": None, "ZIP_Code": None}))
    write("c/p3.json", {"features": []})
    df = files.read_feature_pages(spark, str(tmp_path / "c"), CRIME_ATTRIBUTES)
    assert rows(df) == [(1672531200000.0, "THEFT", "37213.0"), (1672531200000.0, None, None)]


def test_feature_pages_numbers_become_text_where_codes_are_text(spark, write):
    df = files.read_feature_pages(spark, write("p.json", page({"PropZip": 37203, "LUCode": 11, "OwnDate": 1})), PROPERTY_ATTRIBUTES)
    assert rows(df, "PropZip", "LUCode") == [("37203", "11")]


def test_error_page_fails(spark, write, tmp_path):
    write("c/p1.json", page({"ZIP_Code": "1"}))
    write("c/p2.json", {"error": {"code": 400, "message": "bad"}})
    folder = str(tmp_path / "c")
    with pytest.raises(ValueError, match="carries an error"):
        files.assert_no_error_pages(files.read_pages(spark, folder, CRIME_ATTRIBUTES))
    with pytest.raises(PySparkException, match="carries an error"):
        files.read_feature_pages(spark, folder, CRIME_ATTRIBUTES).collect()
    files.assert_no_error_pages(files.read_pages(spark, folder + "/p1.json", CRIME_ATTRIBUTES))


def test_seeds_keep_codes_as_text(spark, write):
    seed = write("r.csv", "zip_code,region,county_name,county_fips\n01234,Core,Davidson,47037\n")
    assert rows(files.read_seed(spark, seed, SEED_REGIONS)) == [("01234", "Core", "Davidson", "47037")]
    cover = write("c.csv", "agency_name,county,zip_code,coverage_type,notes\nA,Wilson,37012,municipal,\n")
    assert rows(files.read_seed(spark, cover, SEED_COVERAGE)) == [("A", "Wilson", "37012", "municipal", None)]


def test_relationship_and_geojson(spark, write):
    rel = write("rel.txt", "GEOID_ZCTA5_20|GEOID_COUNTY_20|AREALAND_PART\n37013|47037|12\n")
    assert rows(files.read_relationship(spark, rel)) == [("37013", "47037", "12")]
    shape = {"type": "Polygon", "coordinates": [[[1.5, 2], [3, 4]]]}
    geo = write("g.json", {"type": "FeatureCollection", "features": [{"properties": {"ZCTA5": "37013"}, "geometry": shape}]})
    (found,) = files.read_geojson(spark, geo).collect()
    assert found["zcta"] == "37013" and '"Polygon"' in found["geometry"] and "1.5" in found["geometry"]


def test_wide_csv_and_named_table(spark, write):
    df = files.read_wide_csv(spark, write("w.csv", "RegionName,State,2024-01-31\n37203,TN,450000.0\n"))
    assert rows(df) == [("37203", "TN", "450000.0", 0)]
    spark.createDataFrame([(date(2024, 1, 1),)], ["d"]).createOrReplaceTempView("some_view")
    assert rows(files.read_table(spark, "some_view")) == [(date(2024, 1, 1),)]
