"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from quotewright.plans.bridge import GIVEN
from quotewright.plans.catalog import QUERIES
from quotewright.plans.oracle import SQL
from tests.oracle_check import connect, differences


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
@pytest.mark.parametrize("name", list(GIVEN))
def test_given_schemas_are_those_of_the_files(spark, scale, name):
    stored = spark.read.parquet(f"/root/testdata/{scale}/{name}.parquet").schema
    assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in GIVEN[name]]


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, sf, name):
    assert differences(spark, duck, sf, QUERIES[name], SQL[name]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "vol_7d_ann" in df.columns
