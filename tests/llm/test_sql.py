"""Operators that SQL can express against their statements, on all documents of a small table."""

import duckdb
import pytest
from hard_rows import SF_DIR

from occrisk.llm.registry import QUERIES, SQL


@pytest.mark.parametrize("name", SQL)
def test_statement(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    got = QUERIES[name](spark, SF_DIR)
    cursor = con.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(cursor.fetchall())


def test_every_operator_is_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
