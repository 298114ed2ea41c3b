from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import duck_oracle
from check_oracle import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert {r.query_id for r in rows} == set(entry.FLAGSHIP)
    assert max(r["rank"] for r in rows) <= 10


def test_every_query_has_sql():
    assert entry._ranking_queries().keys() == duck_oracle.oracle_sql().keys()
    assert entry.queries().keys() >= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", list(duck_oracle.oracle_sql()))
def test_same_rows_as_sql(spark, con, name):
    frame = entry.queries()[name](spark, SF_DIR)
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [item[0] for item in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    ours = rows_of(frame.columns, frame.collect())
    assert ours == rows_of(columns, cursor.fetchall()) and ours
