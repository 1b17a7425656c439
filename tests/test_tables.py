from datetime import date, datetime

import pytest
from conftest import rows

from areascore import schemas
from areascore.sources import files, tables

CRIME = schemas.RAW_TABLES["crime"]
MARKET = schemas.RAW_TABLES["home_values"]
NOW = datetime(2024, 5, 1)


def crime(spark, *stamps, kind="THEFT"):
    return spark.createDataFrame([(t, kind, "37013", NOW) for t in stamps], CRIME)


def test_append_counts_and_empty_is_no_change(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.append(spark.range(3), path) == 3
    assert tables.append(spark.range(0), path) == 0
    assert tables.append(spark.range(2), path) == 2
    assert spark.read.parquet(path).count() == 5


def test_ensure_raw_tables(spark, tmp_path):
    tables.ensure_raw_tables(spark, str(tmp_path))
    for name, schema in schemas.RAW_TABLES.items():
        df = tables.read_raw(spark, str(tmp_path), name)
        assert df.count() == 0 and df.columns == schema.names
    tables.append(crime(spark, NOW).withColumn("part_month", __import__("pyspark").sql.functions.lit(date(2024, 5, 1))), str(tmp_path / "x"))
    tables.ensure_raw_tables(spark, str(tmp_path))


def test_replace_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    want = [(1, "a"), (2, "B"), (3, "C"), (None, "c")]
    assert rows(tables.replace_keys(old, new, "k")) == want
    assert rows(tables.replace_keys(old, new.limit(0), "k")) == rows(old)


def test_replace_keys_within_scope(spark):
    old = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "x", 3)], "k int, s string, v int")
    new = spark.createDataFrame([(1, "x", 9)], "k int, s string, v int")
    assert rows(tables.replace_keys(old, new, "k", "s")) == [(1, "x", 9), (1, "y", 2), (2, "x", 3)]


def test_replace_from_keeps_what_lies_before(spark):
    old = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 31),), (date(2024, 3, 1),), (None,)], "d date")
    new = spark.createDataFrame([(date(2024, 2, 1),)], "d date")
    assert rows(tables.replace_from(old, new, "d", "2024-01-31")) == [(None,), (date(2024, 1, 1),), (date(2024, 2, 1),)]


def test_write_replace_from(spark, tmp_path):
    path, add = str(tmp_path / "crime"), lambda new, cut: tables.write_replace_from(spark, path, new, "incident_occurred", cut, CRIME).rows
    stored = lambda: rows(tables.read_range_table(spark, path, CRIME), "incident_occurred", "incident_type")
    first = crime(spark, datetime(2024, 1, 5), datetime(2024, 1, 20, 12), datetime(2024, 2, 3), datetime(2024, 4, 1))
    assert add(first, "2010-01-01T00:00:00") == 4
    again = stored()
    assert add(first, "2010-01-01T00:00:00") == 4
    assert stored() == again

    # The cutoff lies inside January: the 5th stays, the 20th is replaced, April has no new row.
    late = crime(spark, datetime(2024, 1, 21), datetime(2024, 2, 9), kind="LATE")
    assert add(late, "2024-01-20T12:00:00") == 2
    want = [
        (datetime(2024, 1, 21), "LATE"), (datetime(2024, 1, 5), "THEFT"), (datetime(2024, 2, 9), "LATE"),
    ]
    assert sorted(stored()) == sorted(want)
    assert add(late, "2024-01-20T12:00:00") == 2
    assert sorted(stored()) == sorted(want)


def test_write_replace_from_reads_and_writes_only_the_tail(spark, tmp_path):
    path = tmp_path / "crime"
    tables.write_replace_from(spark, str(path), crime(spark, datetime(2023, 1, 1), datetime(2024, 1, 1)), "incident_occurred", "2010-01-01", CRIME)
    old = sorted(f.name for f in (path / "part_month=2023-01-01").iterdir())
    tables.write_replace_from(spark, str(path), crime(spark, datetime(2024, 1, 2)), "incident_occurred", "2024-01-01", CRIME)
    assert sorted(f.name for f in (path / "part_month=2023-01-01").iterdir()) == old


def test_write_replace_keys(spark, tmp_path):
    path = str(tmp_path / "values")
    make = lambda *cells: spark.createDataFrame([(z, "TN", None, None, d, v, m, NOW) for z, d, v, m in cells], MARKET)
    jan, jan2, feb = date(2024, 1, 31), date(2024, 1, 15), date(2024, 2, 29)
    put = lambda df: tables.write_replace_keys(spark, path, df, "period_month", MARKET, "metric_type").rows
    assert put(make(("1", jan, 1.0, "ZHVI"), ("1", jan2, 2.0, "ZHVI"), ("1", feb, 3.0, "ZHVI"))) == 3
    assert put(make(("1", jan, 4.0, "ZORI"))) == 1
    assert put(make(("2", jan, 5.0, "ZHVI"))) == 1
    want = [("1", jan, 4.0), ("1", jan2, 2.0), ("1", feb, 3.0), ("2", jan, 5.0)]
    assert rows(tables.read_range_table(spark, path, MARKET), "zip_code", "period_month", "value") == sorted(want, key=repr)
    assert put(make(("2", jan, 5.0, "ZHVI"))) == 1
    assert put(make()) == 0
    assert rows(tables.read_range_table(spark, path, MARKET), "zip_code", "period_month", "value") == sorted(want, key=repr)


def test_state_round_trip(spark, tmp_path):
    path = str(tmp_path / "state")
    assert tables.get_state(spark, path, "market") == (None, None)
    tables.set_state(spark, path, "market", "2024-03-31", '"abc"')
    assert tables.get_state(spark, path, "market") == ("2024-03-31", '"abc"')
    tables.set_state(spark, path, "market", "2024-04-07")
    assert tables.get_state(spark, path, "market") == ("2024-04-07", '"abc"')
    tables.set_state(spark, path, "market", etag='"def"')
    assert tables.get_state(spark, path, "market") == ("2024-04-07", '"def"')
    tables.set_state(spark, path, "crime", "2024-01-01T00:00:00")
    assert tables.get_state(spark, path, "market") == ("2024-04-07", '"def"')
    assert tables.get_state(spark, path, "crime") == ("2024-01-01T00:00:00", None)


def test_expiry_keeps_what_readers_and_running_loads_need(spark, tmp_path):
    path, put = str(tmp_path / "crime"), lambda day: tables.write_replace_from(spark, str(tmp_path / "crime"), crime(spark, datetime(2024, 1, day)), "incident_occurred", "2024-01-01", CRIME)
    for day in range(1, 6):
        put(day)
    loads = lambda: sorted(f.name for f in (tmp_path / "crime" / "part_month=2024-01-01").iterdir())
    assert len(loads()) == 5
    assert tables.expire(spark, path) == 0 and len(loads()) == 5  # all is young
    old = tables.read_range_table(spark, path, CRIME)
    running = tables._Load(spark, path, CRIME)
    running.write(crime(spark, datetime(2024, 1, 9)).withColumn("part_month", tables.month_of(tables.F.col("incident_occurred"))))
    assert tables.expire(spark, path, keep=2, grace=3600) == 0
    assert tables.expire(spark, path, keep=5, grace=0) == 1  # the load that no manifest lists yet
    assert tables.expire(spark, path, keep=2, grace=0) == 3
    assert rows(old, "incident_occurred") == [(datetime(2024, 1, 5),)] and len(loads()) == 2
    put(6)
    assert tables.expire(spark, path, keep=1, grace=0) == 2
    assert rows(tables.read_range_table(spark, path, CRIME), "incident_occurred") == [(datetime(2024, 1, 6),)]
    assert tables.expire(spark, str(tmp_path / "none")) == 0


def test_a_log_is_folded_into_its_newest_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    add = lambda *r: spark.createDataFrame([*r], "k string, v long").coalesce(1).write.mode("append").parquet(path)
    read = lambda: dict(spark.read.parquet(path).groupBy("k").agg(tables.F.max("v")).collect())
    files = lambda: sum(f.suffix == ".parquet" for f in (tmp_path / "log").iterdir())
    fold = lambda grace: tables.fold_log(spark, path, "k string, v long", ["k"], "v", most=3, grace=grace)
    assert not fold(0)
    for i in range(3):
        add(("a", i), ("b", 1))
    assert not fold(0)
    add(("c", 7))
    before = spark.read.parquet(path)
    want = {"a": 2, "b": 1, "c": 7}
    assert fold(3600) and files() == 5 and read() == want
    assert before.count() == 7  # a reader that has the old files goes on
    assert not fold(3600) and files() == 5
    assert not fold(0) and files() == 1 and read() == want
    assert spark.read.parquet(path).count() == 3


def test_init_state_adds_only_missing(spark, tmp_path):
    path = str(tmp_path / "state")
    tables.set_state(spark, path, "crime", "2024-01-01")
    assert tables.write_init_state(spark, path, [("crime", "2020-01-01"), ("property", "2020-01-01")]) == 1
    assert tables.get_state(spark, path, "crime")[0] == "2024-01-01"
    assert tables.get_state(spark, path, "property")[0] == "2020-01-01"
    assert tables.write_init_state(spark, path, [("crime", None)]) == 0
    tables.set_state(spark, path, "property", "2021-01-01")
    assert tables.get_state(spark, path, "property")[0] == "2021-01-01"


def test_layers_and_publish(spark):
    assert tables.table_name("marts", "geography") == "marts.geography"
    assert tables.table_name(" staging ", "x") == "staging.x"
    with pytest.raises(KeyError):
        tables.table_name("dev", "x")
    view = tables.publish(spark.range(2), "staging", "some_stage")
    table = tables.publish(spark.range(3), "marts", "some_mart")
    assert (view.count(), table.count(), spark.table("marts.some_mart").count()) == (2, 3, 3)
    assert spark.table("some_stage").count() == 2
    tables.publish(spark.range(1), "marts", "some_mart")
    assert spark.table("marts.some_mart").count() == 1


def test_audit_defaults(spark, tmp_path):
    path = str(tmp_path / "audit")
    run = tables.append_audit(spark, path, "daily", "success", tests_run=61, tests_passed=61, crime="pass")
    tables.append_audit(spark, path, "daily", "failure", run_id="r2", now=NOW, notes="n")
    got = {r["run_id"]: r for r in spark.read.parquet(path).collect()}
    assert len(run) == 36 and got[run]["freshness_crime"] == "pass" and got[run]["run_timestamp"] is not None
    assert (got["r2"]["run_timestamp"], got["r2"]["tests_run"], got["r2"]["freshness_crime"]) == (NOW, 0, None)
    with pytest.raises(ValueError, match="no audit columns"):
        tables.append_audit(spark, path, "daily", "success", weather="pass")


def test_seed_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("01234",), ("37013",)], schemas.SEED_VALID)
    tables.write_seed(df, str(tmp_path / "valid"))
    assert rows(files.read_seed(spark, str(tmp_path / "valid"), schemas.SEED_VALID)) == [("01234",), ("37013",)]
