"""Every registered query against its DuckDB text on whole tables."""

import pytest
from conftest import SF
from oracle import connect, differences

import __spark_entry__ as entry_points
from cardlake.catalog.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SF), ORACLE[name], con) == []


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() == 4
