import pytest

from __spark_entry__ import entry
from compare import difference, open_tables
from queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return open_tables(SF)


def test_every_query_has_a_twin_and_no_twin_is_alone():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql_twin(spark, db, name):
    count, problem = difference(QUERIES[name](spark, SF), db, ORACLES[name])
    assert problem is None and count > 0


def test_entry_scores_every_area(spark):
    df = entry(spark)
    assert df.count() == 25 and "opportunity_score" in df.columns
    labels = {r["data_confidence"] for r in df.collect()}
    assert labels == {"High", "Partial", "Low"}
