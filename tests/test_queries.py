"""Every registered query beside its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from reelforge.plans.catalog import QUERIES
from tools.check import oracle, ordered


@pytest.fixture(scope="module")
def connection(small_dir):
    return oracle(small_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, small_dir, name):
    frame = QUERIES[name].build(spark, small_dir)
    rows = [tuple(row) for row in frame.collect()]
    sql = QUERIES[name].sql
    if sql is None:
        assert rows
        return
    result = connection.sql(sql)
    assert sorted(frame.columns) == sorted(result.columns)
    assert ordered(rows, frame.columns) == ordered(result.fetchall(), result.columns)


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["startYear", "n_titles", "mean_votes", "n_action", "n_science_fiction", "median_votes"]
    assert frame.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
