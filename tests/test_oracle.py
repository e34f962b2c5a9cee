"""Every registered query against DuckDB on the same tables."""

import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point
import oracle
from meterline.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, ORACLE = catalog.QUERIES, oracle.SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype) in ("object", "str", "string"):
            df[c] = df[c].map(lambda v: None if v is None or v != v else str(v))
        elif "datetime" in str(df[c].dtype):
            df[c] = df[c].astype("datetime64[us]")
        elif str(df[c].dtype) != "bool":
            df[c] = df[c].astype("float64")
    return df.sort_values(list(df.columns), key=lambda s: s.astype(str), kind="stable").reset_index(drop=True)


def check_plan(df):
    """No cross join, no Python in the plan, no window over a whole table in one task."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan
    assert not re.search(r"Window \[[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_queries_are_registered():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    check_plan(result)
    got = canonical(result.toPandas())
    want = canonical(duck.sql(ORACLE[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    for column in got.columns:
        left, right = got[column], want[column]
        same = (left == right) | (left.isna() & right.isna())
        assert same.all(), f"{column}: {left[~same].head(3).tolist()} != {right[~same].head(3).tolist()}"


def test_entry_returns_top_zones(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["zone_id", "zone_name", "borough", "trip_count", "avg_fare"]
    assert result.count() == 10


def test_adapter_counts(spark):
    """Reject counts computed independently for this data."""
    rows = {r.rule: r.rejected for r in QUERIES["dq_rejections"](spark, SF_DIR).collect()}
    assert rows == {"temporal_invalid": 271, "speed_invalid": 568, "negative_amount": 54}
