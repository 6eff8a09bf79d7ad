"""Every registered query against its SQL oracle at the smallest scale."""

import pytest

import __spark_entry__ as entry
import catalog
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert difference(df, duck, entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert sorted(df.columns) == sorted("year month year_month nation members rows total rank".split())
    assert df.filter("rank > 10").isEmpty() and not df.isEmpty()
