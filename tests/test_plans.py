"""Physical plans: what must not appear at any scale, and what must reach the scan."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from meterline.operators import kpis, staging
from meterline.plans import reports
from meterline.plans.catalog import AS_OF, QUERIES, SALT, Inputs
from meterline.sources.tables import KeyedTable

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    inputs = Inputs(spark, SF_DIR)
    inputs.curated.write.parquet(str(root / "curated"))
    inputs.staged.write.parquet(str(root / "staged"))
    return root


def test_kpi_range_is_pushed_and_columns_pruned(spark, stored):
    staged = spark.read.parquet(str(stored / "staged"))
    plan = plan_of(kpis.kpi_backfill(staged, dt.datetime(2025, 1, 3), dt.datetime(2025, 1, 5)))
    assert "GreaterThanOrEqual(pickup_ts" in plan and "LessThan(pickup_ts" in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert len(schemas) == 2 and all("trip_key" not in s for s in schemas)
    assert min(len(s.split(",")) for s in schemas) == 3


def test_kpi_sides_join_without_another_shuffle(spark, stored):
    """One exchange for the measures, two for the vehicles (by key, then by zone and hour)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(kpis.zone_hourly_kpis(spark.read.parquet(str(stored / "staged"))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") <= 3


def test_validation_reaches_the_scan(spark, stored):
    curated = spark.read.parquet(str(stored / "curated"))
    plan = plan_of(staging.stage_trips(curated, SALT, "batch", AS_OF))
    for pushed in ("GreaterThanOrEqual(vendor_id,1)", "LessThanOrEqual(do_zone_id,265)", "IsNotNull(pu_zone_id)"):
        assert pushed in plan
    assert "Exchange" not in plan


def test_top_zones_aggregates_before_the_join(spark, stored):
    inputs = Inputs(spark, SF_DIR)
    plan = plan_of(reports.top_zones(spark.read.parquet(str(stored / "staged")), inputs.zones))
    assert "TakeOrderedAndProject" in plan
    assert "partial_count" in plan[plan.index("Join"):]


def test_sessions_combine_before_the_shuffle(spark):
    plan = plan_of(QUERIES["trip_sessions"](spark, SF_DIR))
    assert "partial_count" in plan and plan.count("Exchange hashpartitioning") == 2


def test_dimension_joins_are_sized_not_hinted(spark, stored):
    """With broadcasting off the same queries still run, as shuffled joins."""
    inputs = Inputs(spark, SF_DIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = staging.trips_with_zones(spark.read.parquet(str(stored / "staged")), inputs.zones)
        assert "Broadcast" not in plan_of(rows)
        assert rows.agg(F.count("*")).first()[0] == spark.read.parquet(str(stored / "staged")).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_order_lines_are_joined_after_orders_met_customers(spark):
    """However large the customers are, lines are moved by order only and not again by customer."""
    import re

    from meterline.sources import star

    plan = star.raw_trips(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"Join Inner, \((\w+)#", plan) == ["l_suppkey", "l_orderkey", "o_custkey"]


def test_kpi_deliveries_share_their_joins(spark, monkeypatch):
    """Both deliveries read stored trips; neither joins the order lines again."""
    read, upsert = [], KeyedTable.upsert

    def seen(table, session, updates, *rest):
        read.append(updates.inputFiles())
        return upsert(table, session, updates, *rest)

    monkeypatch.setattr(KeyedTable, "upsert", seen)
    assert QUERIES["upsert_kpis"](spark, SF_DIR).count() > 0
    assert len(read) == 2 and all(read) and not any("lineitem" in name for names in read for name in names)
