"""Every registered query against its SQL in DuckDB, value by value."""

import os

import pytest
from compare import differences, duck

import __spark_entry__ as entry_point
from fleetday.plans import oracle, queries

SF_DIR = os.environ.get("FLEETDAY_TEST_SF", "/root/testdata/sf0.001")
QUERIES = queries.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert SQL.items() <= entry_point.oracle_sql().items() and QUERIES.keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


# Known totals of the adjusted table: riders' days, days with something moved, emptied days, trips.
@pytest.mark.parametrize("sf, expected", [("0.001", (397, 33, 3, 600)), ("0.01", (4006, 367, 47, 5981))])
def test_flagship_totals(spark, sf, expected):
    from pyspark.sql import functions as F

    from fleetday.plans.queries import _tables
    from fleetday.sources.tables import stage

    tables = _tables(spark, f"/root/testdata/sf{sf}")
    adjusted = stage(tables.adjusted, "test")
    moved = adjusted.filter("_frac_horas_dbg > 0").count()
    trips = adjusted.agg(F.sum("num_of_trips")).first()[0]
    tables.adjusted = adjusted
    assert (adjusted.count(), moved, tables.emptied.count(), trips) == expected
