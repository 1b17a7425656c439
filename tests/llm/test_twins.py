"""The queries with a SQL twin give its rows exactly."""

import pytest

from areascore.llm.queries import ORACLES, QUERIES
from compare import difference, open_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return open_tables(SF)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == [*range(1, 14)]


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_twin(spark, db, name):
    count, problem = difference(QUERIES[name](spark, SF), db, ORACLES[name])
    assert problem is None and count > 0
