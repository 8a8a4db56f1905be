"""Every registered query against its SQL statement, or rows only where it has none."""

import pytest

import __spark_entry__ as entry_file
from tests.oracle import connect, difference

SF = "sf0.01"
QUERIES = entry_file.queries()
ORACLES = entry_file.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem, _ = difference(spark, con, SF, name, QUERIES[name], ORACLES.get(name))
    assert problem is None


def test_entry(spark):
    df = entry_file.entry(spark)
    assert df.columns == ["src", "dst", "weight", "norm_weight"]
    assert df.count() >= 5


def test_oracles_name_registered_queries():
    assert set(ORACLES) <= set(QUERIES)
