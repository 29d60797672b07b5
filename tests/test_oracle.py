"""Every named query against its SQL statement, on whole tables."""

import pytest
from compare import connect, differences
from conftest import SF_DIR

import __spark_entry__ as entry_points
from tellerlake.plans.oracle import ORACLE
from tellerlake.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df, con, ORACLE[name]) == []


def test_entry_returns_every_customer(spark):
    assert entry_points.entry(spark).count() == 150
