"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from hunian.plans import catalog
from tests.compare import connect, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert spark_rows(entry.queries()[name](spark, FOLDER)) == sql_rows(con, entry.oracle_sql()[name])


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["page", "kecamatan", "cat_a", "cat_b"] and df.count() > 0
