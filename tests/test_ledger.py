"""KPIs kept by changes equal KPIs of a full refresh, whatever the order and repetition of deliveries."""

import datetime as dt
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterline.operators import kpis, ledger
from meterline.plans import pipeline
from meterline.schemas import COMPLETE_TRIP
from meterline.sources import tables
from meterline.sources.tables import kpi_ledger, mart_table, path_exists, staging_table

D = dt.datetime
AS_OF = D(2025, 2, 1)


def rows(spark, *trips):
    """(key, pickup, zone, vehicle, fare) as staging rows."""
    full = [(k, 1, p, p + dt.timedelta(minutes=9), z, 2, 1, 1.5, f, 0.5, f, 1, v, "test", p, p) for k, p, z, v, f in trips]
    return spark.createDataFrame(full, COMPLETE_TRIP)


@pytest.fixture
def stores(tmp_path):
    return staging_table(str(tmp_path / "t"), keep_changes=True), kpi_ledger(str(tmp_path / "s")), mart_table(str(tmp_path / "m"))


def take(spark, stores, batch, *trips):
    stores[0].upsert(spark, rows(spark, *trips), batch)
    return pipeline.refresh_changed_kpis(spark, *stores, AS_OF, batch)


def from_ledger(spark, sums):
    return sorted(map(str, ledger.ledger_kpis(sums.read(spark)).select(*COLUMNS).collect()))


def from_trips(spark, trips):
    return sorted(map(str, kpis.zone_hourly_kpis(trips.read(spark)).select(*COLUMNS).collect()))


COLUMNS = ("zone_id", "hour_ts", "trips", *ledger.AVERAGES, "pct_card", "unique_vehicles")
H1, H2, OTHER_DAY = D(2025, 1, 1, 10, 5), D(2025, 1, 1, 11, 5), D(2025, 1, 3, 10)


def test_corrections_take_back_what_they_replace(spark, stores):
    trips, sums, mart = stores
    take(spark, stores, "1", ("a", H1, 1, "x", 10.1), ("b", H1, 1, "x", 20.2), ("c", H1, 1, "y", 1.0), ("d", H2, 1, None, 5.0), ("e", H1, None, "x", 5.0))
    assert from_ledger(spark, sums) == from_trips(spark, trips)
    # a vehicle corrected away, a trip moved to another hour and zone, a missing and an infinite fare
    take(spark, stores, "2", ("c", H1, 1, "x", 1.0), ("d", OTHER_DAY, 2, "y", float("nan")), ("f", H1, 1, "z", None), ("g", H2, 3, "z", float("inf")))
    assert from_ledger(spark, sums) == from_trips(spark, trips)
    vehicles = {(r.zone_id, r.hour_ts): r.unique_vehicles for r in mart.read(spark).collect()}
    assert vehicles[1, D(2025, 1, 1, 10)] == 2 and vehicles[2, D(2025, 1, 3, 10)] == 1
    # bad values that are corrected leave no trace
    take(spark, stores, "3", ("d", OTHER_DAY, 2, "y", 7.0), ("g", H2, 3, "z", 8.0))
    assert from_ledger(spark, sums) == from_trips(spark, trips)


def test_repeated_unchanged_and_empty_deliveries(spark, stores):
    trips, sums, mart = stores
    first = ("a", H1, 1, "x", 10.1), ("b", H2, 1, "x", 20.2)
    assert take(spark, stores, "1", *first) == 2
    before = from_ledger(spark, sums)
    assert take(spark, stores, "1", *first) == 0
    assert pipeline.refresh_changed_kpis(spark, *stores, AS_OF, "1") == 0 and from_ledger(spark, sums) == before
    # the same rows under another name change no KPI, so no hour is touched
    assert take(spark, stores, "2", *first) == 0 and from_ledger(spark, sums) == before
    trips.upsert(spark, rows(spark), "3")
    assert pipeline.refresh_changed_kpis(spark, *stores, AS_OF, "3") == 0
    trips.forget_changes(spark, "1")
    assert not path_exists(spark, f"{trips.path}/_changes/1") and trips.changes(spark, "1").isEmpty()


def test_deliveries_in_another_order(spark, stores):
    trips, sums, mart = stores
    trips.upsert(spark, rows(spark, ("a", H1, 1, "x", 10.0), ("b", H1, 1, "y", 2.0)), "1")
    trips.upsert(spark, rows(spark, ("a", H2, 1, "x", 11.0)), "2")
    for batch in ("2", "1"):
        pipeline.refresh_changed_kpis(spark, *stores, AS_OF, batch)
    assert from_ledger(spark, sums) == from_trips(spark, trips)


def test_only_touched_days_of_the_ledger_are_read(spark, stores):
    trips, sums, mart = stores
    take(spark, stores, "1", ("a", H1, 1, "x", 10.0), ("b", OTHER_DAY, 1, "y", 2.0))
    untouched = {p: p.stat().st_mtime_ns for p in Path(sums.path).glob("hour_day=2025-01-01/*")}
    plan = sums.read_partitions(spark, [OTHER_DAY.date()])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour_day" in plan
    take(spark, stores, "2", ("b", OTHER_DAY, 1, "y", 3.0))
    assert untouched and all(p.stat().st_mtime_ns == t for p, t in untouched.items())
    plan = ledger.contributions(trips.changes(spark, "2"))._jdf.queryExecution().executedPlan().toString()
    assert "_changes/2" in plan and "SortAggregate" not in plan


def test_contributions_of_no_change_are_empty(spark):
    same = rows(spark, ("a", H1, 1, "x", 10.0))
    both = same.withColumn(ledger.SIGN, F.lit(1)).unionByName(same.withColumn(ledger.SIGN, F.lit(-1)))
    assert ledger.contributions(both).isEmpty()


def test_a_delivery_moves_and_writes_its_rows_once(spark, stores, monkeypatch):
    """New rows are kept as what changed and not copied, stored rows meet them once, and few days are written where rows are read."""
    trips, sums, mart = stores
    plans, write = {}, tables._write

    def noted(rows, path, *partition):
        plans[path.rsplit("/", 1)[-1]] = rows._jdf.queryExecution().executedPlan().toString()
        write(rows, path, *partition)

    monkeypatch.setattr(tables, "_write", noted)
    # one key comes twice in the first delivery, one row is replaced by the second
    take(spark, stores, "1", ("a", H1, 1, "x", 10.0), ("b", H1, 1, "y", 2.0), ("b", H2, 1, "y", 3.0), ("c", OTHER_DAY, 1, "y", 4.0), ("d", H1, 2, "z", 5.0), ("e", H1, 2, "z", 5.0))
    assert set(plans) == {"arrived", "winners", "merged"} and "Exchange hash" not in plans["merged"]
    plans.clear()
    trips.upsert(spark, rows(spark, ("a", H2, 1, "x", 11.0), ("f", H1, 1, "w", 6.0)), "2")
    assert set(plans) == {"arrived", "winners", "old", "merged"} and "pickup_day=" not in plans["merged"] and "Exchange hash" not in plans["merged"]
    signs = sorted((r.change_sign, r.trip_key, r.fare_amount) for r in trips.changes(spark, "2").collect())
    assert signs == [(-1, "a", 10.0), (1, "a", 11.0), (1, "f", 6.0)]
    assert sorted((r.change_sign, r.trip_key, r.fare_amount) for r in trips.changes(spark, "1").collect()) == [
        (1, "a", 10.0), (1, "b", 3.0), (1, "c", 4.0), (1, "d", 5.0), (1, "e", 5.0)]
    pipeline.refresh_changed_kpis(spark, *stores, AS_OF, "2")
    assert from_ledger(spark, sums) == from_trips(spark, trips)
    # many days would leave too few tasks
    monkeypatch.setattr(tables, "FEW_DAYS", 1)
    take(spark, stores, "3", ("c", OTHER_DAY, 1, "x", 4.0), ("g", H1, 1, "x", 1.0))
    assert "REBALANCE" in plans["merged"] and from_ledger(spark, sums) == from_trips(spark, trips)


def test_a_lost_driver_goes_on_from_the_kept_delivery(spark, stores):
    """Staged and half published; also changes that an earlier version wrote with their sign."""
    trips, sums, mart = stores
    trips.upsert(spark, rows(spark, ("a", H1, 1, "x", 10.0), ("b", OTHER_DAY, 1, "y", 2.0)), "1")
    update = rows(spark, ("a", H1, 1, "x", 11.0), ("a", H1, 1, "x", 12.0), ("c", H1, 1, "x", 1.0))
    trips._stage(spark, update, ("fare_amount",), trips.stage_path("2"), trips._changes_path("2"))
    shutil.rmtree(f"{trips.path}/pickup_day=2025-01-01")
    assert trips.upsert(spark, update, "2", ("fare_amount",)) == 2
    assert {(r.trip_key, r.fare_amount) for r in trips.read(spark).collect()} == {("a", 12.0), ("b", 2.0), ("c", 1.0)}
    for batch in ("1", "2"):
        pipeline.refresh_changed_kpis(spark, *stores, AS_OF, batch)
    assert from_ledger(spark, sums) == from_trips(spark, trips)
    old = rows(spark, ("a", H1, 1, "x", 10.0)).withColumn(ledger.SIGN, F.lit(-1))
    old.write.parquet(f"{trips.path}/_changes/old")
    assert [(r.trip_key, r.change_sign) for r in trips.changes(spark, "old").collect()] == [("a", -1)]
