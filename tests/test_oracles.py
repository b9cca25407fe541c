"""Every registered query against independent SQL on the small sample."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from statledger.checks import oracles, queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()
EMPTY_HERE = {"unneeded_indexes"}  # no index of the small sample qualifies; it has rows at larger scales


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    found = differences(QUERIES[name](spark, FOLDER), con, ORACLES[name])
    if name in EMPTY_HERE:
        found = [m for m in found if m != "empty"]
    assert not found


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_comparison_sees_differences(spark, con):
    df = spark.sql("SELECT CAST(1 AS BIGINT) AS a, 'x' AS b")
    assert not differences(df, con, "SELECT CAST(1 AS BIGINT) AS a, 'x' AS b")
    assert differences(df, con, "SELECT CAST(2 AS BIGINT) AS a, 'x' AS b")
    assert differences(df, con, "SELECT '1' AS a, 'x' AS b")
    assert differences(df, con, "SELECT CAST(1 AS BIGINT) AS a, 'x' AS c")
