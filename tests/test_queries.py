"""Every registered query that has SQL is held against DuckDB on the smallest tables, row for row."""

import os
from decimal import Decimal

import duckdb
import pytest

from quarrylens import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DATA}/{name}')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return "dec", str(v.normalize() + 0)
    return type(v).__name__, repr(v) if isinstance(v, float) else str(v)


def rows_of(table):
    names = sorted(table.column_names)
    return names, sorted(tuple(map(plain, r)) for r in zip(*(table.column(c).to_pylist() for c in names), strict=True))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    assert rows_of(QUERIES[name](spark, DATA).toArrow()) == rows_of(duck.execute(SQL[name]).to_arrow_table())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).columns
