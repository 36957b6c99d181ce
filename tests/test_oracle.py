"""Every query with a DuckDB twin gives the same columns, types and rows."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        view = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{DATA}/{name}'")
    return connection


def sorted_rows(rows, order):
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: [(v is not None, v) for v in row],
    )


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_oracle(spark, duck, name):
    frame = queries()[name](spark, DATA)
    result = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(columns)
    types = {c[0]: str(c[1]) for c in result.description}
    assert {c: KINDS[t] for c, t in frame.dtypes} == types
    expected = sorted_rows(result.fetchall(), [columns.index(c) for c in sorted(columns)])
    found = sorted_rows(frame.collect(), [frame.columns.index(c) for c in sorted(columns)])
    assert expected
    assert found == expected


@pytest.mark.parametrize("name", sorted(n for n in oracle_sql() if "ORDER BY" in oracle_sql()[n][-120:]))
def test_same_order_as_oracle(spark, duck, name):
    frame = queries()[name](spark, DATA)
    result = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert [tuple(r[c] for c in columns) for r in frame.collect()] == result.fetchall()


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark, duck):
    smoke = DATA.replace("sf0.01", "sf0.001")
    sql = oracle_sql()["report_merchant_exposure"].replace("FROM orders", f"FROM '{smoke}/orders.parquet'")
    assert sorted(tuple(r) for r in entry(spark).collect()) == sorted(duck.execute(sql).fetchall())
