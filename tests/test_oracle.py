"""Every registered query against its oracle SQL at the smallest scale; queries without SQL must give rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of

BASE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{BASE}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, BASE)
    got = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(cols, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
