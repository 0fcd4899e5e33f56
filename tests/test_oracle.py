"""Every registered query with SQL against DuckDB, on the whole table."""

import pytest

import __spark_entry__ as entry
from oracle import compare, duck

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def connection(oracle_sf):
    return duck(oracle_sf)


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
    assert set(entry.REGISTRY) <= set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, connection, oracle_sf, name):
    assert compare(QUERIES[name](spark, oracle_sf), connection, SQL[name]) == []


def test_entry_has_rows(spark):
    result = entry.entry(spark)
    assert len(result.columns) == 15
    assert result.count() > 0


@pytest.mark.parametrize("column", ["unique_editors", "active_pages"])
def test_sketched_counts_stay_near_exact_ones(spark, oracle_sf, column):
    """Over days, where counts are large enough to compare in per cent."""
    from pyspark.sql import functions as F

    from editpulse import testbed
    from editpulse.operators.gold import window_kpis

    silver = testbed.silver_rows(testbed.events(spark, oracle_sf))
    minutes = 24 * 60
    exact = window_kpis(silver, minutes).select("window_start", F.col(column).alias("exact"))
    near = window_kpis(silver, minutes, "approx").select("window_start", F.col(column).alias("near"))
    rows = exact.join(near, "window_start").collect()
    assert len(rows) == 30
    assert all(abs(row.near - row.exact) <= 0.15 * row.exact for row in rows)
