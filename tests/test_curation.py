import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from meterline.functions.hashing import iso_text, trip_key, vehicle_id
from meterline.functions.numeric import nan_to_null
from meterline.operators import kpis, quality, staging, validation
from meterline.plans import profiles

D = dt.datetime
RAW = "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, trip_distance double, total_amount double"


def test_derived_fields(spark):
    df = spark.createDataFrame([(D(2025, 1, 1, 10), D(2025, 1, 1, 10, 30), 1.0, 5.0),
                                (D(2025, 1, 1, 10), D(2025, 1, 1, 10), 1.0, 5.0)], RAW)
    first, still = quality.derived_fields(df).collect()
    assert first.distance_km == pytest.approx(1.60934, abs=1e-5)
    assert first.duration_min == pytest.approx(30.0)
    assert first.avg_speed_kmh == pytest.approx(3.21868, abs=1e-5)
    assert still.avg_speed_kmh is None


def dq_rows(spark):
    at = lambda h, m=0: D(2025, 1, 1, h, m)
    rows = [(at(10), at(10, 30), 50.0, 10.0), (at(11), at(10, 30), 100.0, 20.0), (at(12), at(12, 30), 250.0, 30.0),
            (at(13), at(13, 30), 75.0, -5.0)]
    return spark.createDataFrame(
        rows, "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, avg_speed_kmh double, total_amount double")


def test_one_rejection_per_rule(spark):
    df = dq_rows(spark)
    assert {r.rule: r.rejected for r in quality.dq_rejections(df).collect()} == {
        "temporal_invalid": 1, "speed_invalid": 1, "negative_amount": 1}
    assert [r.total_amount for r in quality.dq_filter(df).collect()] == [10.0]


def test_missing_values_in_rules(spark):
    at = D(2025, 1, 1, 10)
    df = spark.createDataFrame(
        [(at, at + dt.timedelta(minutes=5), float("nan"), 3.0), (at, None, 1.0, 3.0),
         (at, at + dt.timedelta(minutes=5), 1.0, float("nan"))],
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, avg_speed_kmh double, total_amount double")
    reasons = [r.reject_reason for r in quality.with_reject_reason(nan_to_null(df)).collect()]
    assert reasons == [None, "temporal_invalid", "negative_amount"]


def test_rename(spark):
    df = spark.createDataFrame([(1, 2, 3, 1.5, "x")], "VendorID int, PULocationID int, RatecodeID int, Airport_fee double, extra_col string")
    assert quality.standardize_columns(df).columns == ["vendor_id", "pu_zone_id", "rate_code", "airport_fee", "extra_col"]


def test_hash_parity_with_hashlib(spark):
    rows = [(1, D(2025, 1, 1, 0, 18, 38), 229, 0), (2, D(2025, 1, 1, 0, 18, 38, 120), 230, 7_001)]
    df = spark.createDataFrame(rows, "vendor int, ts timestamp_ntz, zone int, off bigint")
    got = df.select(
        trip_key("test-salt", F.col("vendor"), F.col("ts"), F.col("zone"), F.col("off")).alias("k"),
        vehicle_id("test-salt", F.col("vendor"), F.col("off")).alias("v"), iso_text(F.col("ts")).alias("iso")).collect()
    for row, (vendor, ts, zone, off) in zip(got, rows):
        assert row.iso == ts.isoformat()
        assert row.k == hashlib.sha256(f"test-salt|{vendor}|{ts.isoformat()}|{zone}|{off}".encode()).hexdigest()
        assert row.v == "veh_" + hashlib.sha256(f"test-salt|vehicle|{vendor}|{off % 5000}".encode()).hexdigest()[:12]
    assert got[0].k == "be4729f0c03bc98f9f7895efbd4795dfa536cde280dec689cd5cc6fd2d88d250"


def test_null_key_parts_are_rejected(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "vendor_id int, pu_zone_id int")
    assert [r[0] for r in df.select(staging.key_reject_reason()).collect()] == [None, "vendor_missing", "zone_missing"]
    assert staging.keyable(df).count() == 1


def test_dense_row_offsets(spark):
    df = spark.range(0, 450_000, 3).select(F.lit(1).alias("month"), F.col("id").alias("row_offset"))
    rows = staging.dense_row_offsets(df.repartition(7), "month")
    assert rows.agg(F.min("row_offset"), F.max("row_offset"), F.count_distinct("row_offset")).first() == (0, 149_999, 150_000)


def test_validation_rules(spark):
    base = dict(trip_key="k", vendor_id=1, pickup_ts=D(2025, 1, 1), dropoff_ts=D(2025, 1, 1, 1), pu_zone_id=1, do_zone_id=265,
                passenger_count=1, trip_distance=1.0, fare_amount=1.0, tip_amount=0.0, total_amount=1.0, payment_type=1,
                vehicle_id_h="veh_1")
    changes = [{}, {"vendor_id": 7}, {"total_amount": 1000.5}, {"passenger_count": None}, {"payment_type": 0},
               {"dropoff_ts": D(2025, 1, 1), "do_zone_id": 266}, {"vehicle_id_h": "v" * 17}, {"pu_zone_id": None}]
    schema = ("trip_key string, vendor_id int, pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, pu_zone_id int, do_zone_id int, "
              "passenger_count int, trip_distance double, fare_amount double, tip_amount double, total_amount double, "
              "payment_type int, vehicle_id_h string")
    df = spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], schema)
    got = [r.failed_rules for r in validation.validate(df, validation.complete_rules()).collect()]
    assert got == [[], ["vendor_id"], ["total_amount"], [], ["payment_type"], ["dropoff_ts", "do_zone_id"],
                   ["vehicle_id_h"], ["pu_zone_id"]]
    assert validation.only_valid(df, validation.complete_rules()).count() == 2
    valid, rejected = validation.split_valid(validation.validate(df, validation.create_rules()))
    assert (valid.count(), rejected.count()) == (3, 5)


def test_strict_contract_rule(spark):
    schema = ("event_type string, event_ts timestamp_ntz, trip_key string, vehicle_id_h string, vendor_id int, pickup_ts timestamp_ntz, "
              "dropoff_ts timestamp_ntz, pu_zone_id int, do_zone_id int, passenger_count int, fare_amount double, "
              "trip_distance double, total_amount double, tip_amount double, payment_type int")
    row = ("IDENTITY", D(2025, 1, 1, 0, 1), "k", "v", 1, D(2025, 1, 1), None, 1, 2, None, None, None, None, None, None)
    df = spark.createDataFrame([row, ("OTHER",) + row[1:]], schema)
    assert [r.failed_rules for r in validation.validate_contract_events(df).collect()] == [[], ["event_type"]]
    assert validation.validate_contract_events(df, strict=True).first().failed_rules == ["event_ts"]


def test_time_ranges():
    r = kpis.incremental_range(D(2025, 1, 15, 10, 30), 12)
    assert (r.start, r.end) == (D(2025, 1, 14, 12), D(2025, 1, 16))
    b = kpis.backfill_range(D(2025, 1, 1), D(2025, 1, 5))
    assert (b.start, b.end) == (D(2025, 1, 1), D(2025, 1, 6))


def test_kpi_values(spark):
    """Average minutes use all rows, average speed only trips that took time."""
    rows = [(1, D(2025, 1, 1, 8, 5), D(2025, 1, 1, 8, 35), 10.0, 20.0, 2.0, 1, "a"),
            (1, D(2025, 1, 1, 8, 50), D(2025, 1, 1, 8, 50), 4.0, 10.0, None, 2, "a"),
            (None, D(2025, 1, 1, 8, 50), D(2025, 1, 1, 8, 55), 4.0, 10.0, 1.0, 2, "b")]
    df = spark.createDataFrame(rows, "pu_zone_id int, pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, trip_distance double, "
                                     "fare_amount double, tip_amount double, payment_type int, vehicle_id_h string")
    (k,) = kpis.zone_hourly_kpis(df).collect()
    assert (k.zone_id, k.hour_ts, k.trips, k.unique_vehicles) == (1, D(2025, 1, 1, 8), 2, 1)
    assert (k.avg_fare, k.avg_tip, k.avg_duration_min, k.pct_card) == (15.0, 2.0, 15.0, 50.0)
    assert k.avg_speed_kmh == pytest.approx(32.1868, abs=1e-5)
    mart = kpis.mart_rows(kpis.zone_hourly_kpis(df), D(2025, 2, 1)).first()
    assert str(mart.avg_speed_kmh) == "32.19" and mart.outlier_rate is None
    empty = kpis.kpi_run_stats(kpis.zone_hourly_kpis(df.limit(0))).first()
    assert (empty.hours_processed, empty.zones_affected) == (0, 0)


def test_distance_stats_hold_the_speed_step(spark):
    """Speeds of 0 < mph < 60 count as speeds; distance and duration keep the trips whose speed is left out."""
    start = D(2025, 1, 1)
    minutes_miles = [(10, 2.0), (30, 20.0), (10, 30.0), (30, 30.0), (0, 1.0), (200, 5.0), (10, 120.0), (None, 1.0), (10, None)]
    df = spark.createDataFrame([(start, None if m is None else start + dt.timedelta(minutes=m), d) for m, d in minutes_miles],
                               "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, trip_distance double")
    got = {r.metric: r for r in profiles.trip_distance_stats(df).collect()}
    assert {m: r.row_count for m, r in got.items()} == {"trip_distance": 4, "trip_duration_min": 4, "avg_speed_mph": 2}
    assert (got["avg_speed_mph"].min, got["avg_speed_mph"].median, got["avg_speed_mph"].max) == pytest.approx((12.0, 26.0, 40.0))
    assert got["trip_distance"].max == 30.0
    assert profiles.speed_mph_stats(df).collect() == [got["avg_speed_mph"]]
    # a duration that is there is not computed again
    given = df.withColumn("trip_duration_min", F.lit(60.0))
    assert {r.metric: r.max for r in profiles.trip_distance_stats(given).collect()}["trip_duration_min"] == 60.0
