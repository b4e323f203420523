"""Every registered query against its DuckDB statement on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DRIVER_TABLES, SF_DIR, rows
from occrisk.queries import all_queries
from oracles import all_statements

QUERIES, ORACLES = all_queries(), all_statements()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in DRIVER_TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted(
        (tuple(r[i] for i in places) for r in cursor.fetchall()),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    assert rows(got.select(*columns)) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
