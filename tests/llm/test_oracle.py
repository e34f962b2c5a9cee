"""Queries that SQL can express, value by value against DuckDB."""

import duckdb
import pytest

from meterline.llm import queries
from tests.llm.conftest import SF_DIR


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(ready, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = con.sql(queries.SQL[name])
    got = queries.QUERIES[name](ready, SF_DIR)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
