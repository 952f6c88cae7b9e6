"""Every registered query against its check SQL, over the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows
from lendscope.checks import oracle
from lendscope.checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "customer_id"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = sql.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(row) for row in df.collect()]) == rows(columns, cursor.fetchall())
