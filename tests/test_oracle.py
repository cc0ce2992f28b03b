"""Every registered query gives the rows of its SQL on the small tables."""

import os

import pytest

import __spark_entry__ as entry
import benchqueries
import oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NO_SQL = {"kmeans_clusters"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(benchqueries.SQL))
def test_query_equals_sql(spark, con, name):
    assert oracle.mismatch(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_every_query_has_sql_or_a_reason():
    assert set(benchqueries.QUERIES) - set(benchqueries.SQL) == NO_SQL
    assert set(benchqueries.QUERIES) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
