"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from leafwright.suite import REGISTRY
from leafwright.suite.fixtures import TABLES

SF = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in entry.queries().items() if name in REGISTRY}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def rows(frame):
    cols = sorted(frame.columns)
    return cols, sorted(tuple(str(v) for v in r) for r in frame[cols].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    got = rows(QUERIES[name](spark, SF).toPandas())
    assert got == rows(duck.sql(SQL[name]).df())


def test_all_have_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
