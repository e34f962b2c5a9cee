import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from meterline.functions.parsing import safe_float, safe_int
from meterline.operators import events as ev
from meterline.operators import state
from meterline.plans.catalog import QUERIES
from meterline.schemas import COMPLETE_TRIP
from meterline.session import configure, configure_store

D = dt.datetime
BASE = D(2025, 1, 1, 10)


def one_trip(spark):
    row = ("k1", 1, BASE, BASE + dt.timedelta(minutes=30), 1, 2, None, 5.5, 15.5, 3.0, 18.5, 1, "veh_1", "batch", BASE, BASE)
    return spark.createDataFrame([row], COMPLETE_TRIP)


def message(event_type, key="k1", seconds=0, **fields):
    body = {"event_id": f"{key}-{event_type}-{seconds}", "trip_key": key, "event_type": event_type, "vendor_id": 1,
            "vehicle_id_h": "veh_1", "timestamp": (BASE + dt.timedelta(seconds=seconds)).isoformat(), **fields}
    return (key, json.dumps(body))


def messages(spark, *rows):
    numbered = [(k, v, i) for i, (k, v) in enumerate(rows)]
    return spark.createDataFrame(numbered, "key string, value string, seq int").coalesce(1)


def test_five_events(spark):
    rows = {r.event_type: r for r in ev.trip_events(one_trip(spark)).collect()}
    offsets = {t: (r.event_ts - BASE).total_seconds() for t, r in rows.items()}
    assert offsets == {"trip_started": 0, "zone_entered": 30, "trip_ended": 1800, "zone_exited": 1830, "payment_processed": 1860}
    assert (rows["trip_started"].pickup_zone_id, rows["trip_started"].passenger_count) == (1, None)
    assert (rows["trip_ended"].dropoff_zone_id, rows["trip_ended"].trip_distance, rows["trip_ended"].trip_duration_minutes) == (2, 5.5, 30.0)
    assert (rows["payment_processed"].fare_amount, rows["payment_processed"].total_amount) == (15.5, 18.5)
    assert len({r.event_id for r in rows.values()}) == 5


def test_base_time_moves_only_the_first_two(spark):
    moved = ev.trip_events(one_trip(spark), F.lit("2025-02-01 00:00:00").cast("timestamp_ntz"))
    days = {r.event_type: r.event_ts.month for r in moved.collect()}
    assert days == {"trip_started": 2, "zone_entered": 2, "trip_ended": 1, "zone_exited": 1, "payment_processed": 1}


def test_json_round_trip(spark):
    sent = ev.events_json(ev.trip_events(one_trip(spark)))
    parsed = ev.parse_messages(sent)
    assert parsed.where("reject_reason is not null").count() == 0
    back = state.assembled_trips_full(state.trip_state(ev.valid_events(parsed)), D(2025, 3, 1)).first()
    assert (back.trip_key, back.pu_zone_id, back.do_zone_id, back.total_amount, back.vehicle_id_h) == ("k1", 1, 2, 18.5, "veh_1")
    assert (back.pickup_ts, back.dropoff_ts) == (BASE, BASE + dt.timedelta(minutes=30))


def test_written_events_are_small(spark, tmp_path):
    """A session of somebody else writes what the queries return in zstd; hashed ids take half their text."""
    other = spark.newSession()
    trip = one_trip(other).drop("trip_key")
    trips = trip.join(other.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("trip_key"))).select(*COMPLETE_TRIP.names)
    sizes = []
    for session in (configure, configure_store):
        session(other)
        sent = ev.trip_events(trips)
        for name, rows in (("events", sent), ("json", ev.events_json(sent))):
            rows.coalesce(1).write.parquet(str(path := tmp_path / f"{name}-{len(sizes)}"))
            sizes.append(sum(f.stat().st_size for f in path.glob("*.parquet")) / 20_000)
            assert other.read.parquet(str(path)).exceptAll(rows).isEmpty()
    assert sizes[2] < 0.6 * sizes[0] and sizes[3] < 0.6 * sizes[1]


def test_a_codec_the_session_names_stands(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.parquet.compression.codec", "gzip")
    assert configure_store(other).conf.get("spark.sql.parquet.compression.codec") == "gzip"
    assert QUERIES["load_zones"](fresh := spark.newSession(), "/root/testdata/sf0.001").count()
    assert fresh.conf.get("spark.sql.parquet.compression.codec") == "zstd"


def test_reject_reasons(spark):
    good = message("trip_started")
    rows = [good, ("k", "not json"), message("lunch_break"), ("k", json.dumps({"event_type": "trip_started", "trip_key": "k"})),
            message("trip_ended", timestamp="soon")]
    got = [r.reject_reason for r in ev.parse_messages(messages(spark, *rows)).orderBy("seq").collect()]
    assert got == [None, "malformed", "unknown_type", "field_missing", "bad_timestamp"]


def test_normalize(spark):
    rows = [message("anything", timestamp="2025-01-01T10:00:00Z", distance_km=2.5), message("", "k1"),
            ("k", json.dumps({"event_type": "x"})), message("anything", seconds=9, timestamp="bad")]
    got = ev.normalize_messages(messages(spark, *rows)).orderBy("seq").collect()
    assert [(r.event_type, r.timestamp, r.bad_timestamp) for r in got] == [
        ("anything", "2025-01-01T10:00:00", False), ("anything", None, True)]
    assert got[0].distance_km == "2.5"


@pytest.mark.parametrize("snapshot, expected", [
    (("1", "15.50", "2", "3.00", "18.50"), (1, 15.5, 2, 3.0, 18.5)),
    (("1", "15.50", None, None, None), (1, 15.5, 0, 0.0, 0.0)),
    (("invalid", "not-a-number", "also-invalid", "None", None), (0, 0.0, 0, 0.0, 0.0)),
    ((None, None, None, None, None), (0, 0.0, 0, 0.0, 0.0)),
])
def test_build_from_snapshot(spark, snapshot, expected):
    df = spark.createDataFrame([("k", *snapshot)], "trip_key string, vendor_id string, fare_amount string, passenger_count string, tip_amount string, total_amount string")
    r = state.build_trips(df).first()
    assert (r.vendor_id, r.fare_amount, r.passenger_count, r.tip_amount, r.total_amount) == expected


def test_safe_parse(spark):
    df = spark.createDataFrame([("5",), (" 7 ",), ("15.5",), ("None",), (None,)], "t string")
    assert [tuple(r) for r in df.select(safe_int(F.col("t")), safe_float(F.col("t"))).collect()] == [
        (5, 5.0), (7, 7.0), (0, 15.5), (0, 0.0), (0, 0.0)]


def test_completion_and_missing(spark):
    rows = [message("trip_started", "a"), message("trip_ended", "a", 5), message("payment_processed", "a", 6),
            message("trip_started", "b"), message("trip_ended", "b", 5), message("zone_entered", "c")]
    trips = state.trip_state(ev.valid_events(ev.parse_messages(messages(spark, *rows))))
    assert [r.trip_key for r in state.complete_trips(trips).collect()] == ["a"]
    assert [r.trip_key for r in state.complete_by_mask(trips).collect()] == ["a"]
    assert state.REQUIRED_MASK == 19
    missing = {r.trip_key: r.missing for r in state.missing_events(trips).collect()}
    assert missing == {"b": ["payment_processed"], "c": ["trip_started", "trip_ended", "payment_processed"]}
    assert state.partial_trip_count(trips).first().open_trips == 2


def pipeline_case(*shape):
    return [message(t, k, i) if t else ("x", "broken") for i, (k, t) in enumerate(shape)]


FULL = ("trip_started", "trip_ended", "payment_processed")


@pytest.mark.parametrize("shape, expected", [
    ([("a", t) for t in FULL], (3, 1, 2)),
    ([("a", t) for t in FULL] + [("b", t) for t in FULL[:2]], (5, 1, 3)),
    ([("a", "trip_started"), ("a", None), ("a", "trip_ended")], (3, 0, 2)),
    ([("a", t) for t in FULL] + [("a", "zone_exited")], (4, 2, 2)),
])
def test_loop_counts(spark, shape, expected):
    parsed = ev.parse_messages(messages(spark, *pipeline_case(*shape)))
    assert tuple(state.assembly_stats(parsed, ("seq",), commit_every=2).first()) == expected


def test_latest_arrival_wins_and_copies_do_nothing(spark):
    rows = [message("payment_processed", "a", 5, fare_amount=1.0), message("payment_processed", "a", 9, fare_amount=2.0),
            message("trip_started", "a", 1), message("trip_ended", "a", 4)]
    once = state.assembled_trips(state.trip_state(ev.valid_events(ev.parse_messages(messages(spark, *rows)))))
    twice = state.assembled_trips(state.trip_state(ev.valid_events(ev.parse_messages(messages(spark, *rows, *rows)))))
    assert once.collect() == twice.collect()
    assert once.first().fare_amount == 2.0


def test_field_state_keeps_older_values(spark):
    rows = [message("trip_started", "a", 1, pickup_zone_id=4, passenger_count=2), message("trip_ended", "a", 9, dropoff_zone_id=5),
            message("trip_started", "a", 12, passenger_count=3)]
    r = state.field_state(ev.normalize_messages(messages(spark, *rows)), ("timestamp", "event_id")).first()
    assert (r.pickup_zone_id, r.passenger_count, r.dropoff_zone_id) == ("4", "3", "5")
    assert (r.trip_started_event_id, r.trip_ended_event_id) == ("a-trip_started-12", "a-trip_ended-9")


def test_flatten_prefers_payload(spark):
    nested = ev.contract_events(one_trip(spark))
    rows = {r.event_type: r for r in ev.flatten_contract(nested).collect()}
    assert rows["IDENTITY"].vehicle_id_h == "veh_1" and rows["PASSENGERS"].vehicle_id_h == "veh_1"
    assert (rows["IDENTITY"].pu_zone_id, rows["DROP"].do_zone_id, rows["TIP"].tip_amount) == (1, 2, 3.0)


def test_late_events_depend_on_the_key_only(spark):
    trips = spark.range(2000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("trip_key"),
                                     F.lit("trip_started").alias("event_type"), F.lit("2025-01-01").cast("timestamp_ntz").alias("event_ts"))
    first = ev.late_events(trips, 3)
    late = {r.trip_key for r in first.where("is_late").collect()}
    assert 20 < len(late) < 120
    assert late == {r.trip_key for r in ev.late_events(trips.repartition(5), 3).where("is_late").collect()}


def test_sessions_split_after_the_gap(spark):
    hours = [0, 5, 10.9, 17, 17.5, 40]
    rows = [message("zone_entered", "a", int(h * 3600)) for h in hours] + [message("trip_started", "b")]
    events = ev.valid_events(ev.parse_messages(messages(spark, *rows)))
    got = sorted((r.trip_key, (r.session_start - BASE).total_seconds() / 3600, (r.session_end - BASE).total_seconds() / 3600, r.events)
                 for r in state.trip_sessions(events).collect())
    assert got == [("a", 0.0, 16.9, 3), ("a", 17.0, 23.5, 2), ("a", 40.0, 46.0, 1), ("b", 0.0, 6.0, 1)]
