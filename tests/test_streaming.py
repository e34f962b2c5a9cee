import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from meterline.operators import events as ev
from meterline.operators import state
from meterline.plans.catalog import Inputs
from meterline.sources import star, topics
from meterline.sources.tables import staging_table
from meterline.streaming import assembly, expiry, fields

AS_OF = dt.datetime(2025, 3, 1)
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def few_state_stores(spark):
    """A stateful query opens a store per partition; the tests need few."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def topic(spark, tmp_path_factory):
    """The event messages as files, in order of time."""
    path = str(tmp_path_factory.mktemp("topic") / "messages")
    star.event_messages(star.table(spark, SF_DIR, "events")).orderBy("seq_id").select("key", "value").repartitionByRange(4, "value") \
        .write.parquet(path)
    return path


@pytest.fixture(scope="module")
def time_ordered(spark, tmp_path_factory):
    """Parsed events, one file per stretch of time, written oldest first."""
    path = str(tmp_path_factory.mktemp("events") / "parsed")
    Inputs(spark, SF_DIR).events.drop("seq_ts", "seq_id", "k").coalesce(1).sortWithinPartitions("event_ts").write.parquet(path)
    return path


def run(query, seconds=120):
    try:
        assert query.awaitTermination(seconds), "stream did not end"
        assert query.exception() is None
    finally:
        query.stop()


def batch_result(spark, topic):
    parsed = ev.parse_messages(spark.read.parquet(topic))
    return state.assembled_trips_full(state.trip_state(ev.valid_events(parsed)), AS_OF)


def test_assembly_equals_batch_and_survives_restart(spark, topic, tmp_path):
    table = staging_table(str(tmp_path / "trips"))
    checkpoint = str(tmp_path / "checkpoint")
    for _ in range(2):
        query = assembly.start_assembly(topics.read_message_files(spark, topic, 1), table, checkpoint, AS_OF)
        run(query)
        got = sorted(table.read(spark).collect())
        assert got == sorted(batch_result(spark, topic).collect()) and got
    # a new checkpoint reads everything again and changes nothing
    run(assembly.start_assembly(topics.read_message_files(spark, topic), table, str(tmp_path / "other"), AS_OF))
    assert sorted(table.read(spark).collect()) == got


def test_progress_counts(spark, topic, tmp_path):
    table = staging_table(str(tmp_path / "trips"))
    stats = assembly.LoopStats()
    query = assembly.start_assembly(topics.read_message_files(spark, topic, 1), table, str(tmp_path / "c"), AS_OF, stats)
    run(query)
    assert stats.ended.wait(60)
    assert stats.events == 1000 and 1 <= stats.commits <= 4
    # a trip that is completed and then corrected in a later micro-batch is taken twice
    assert stats.trips >= table.read(spark).count() > 0


def to_memory(df, name, mode, checkpoint):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run(query)
    return df.sparkSession.table(name)


def test_field_state_stream(spark, topic, tmp_path):
    stream = assembly.field_state_stream(topics.read_message_files(spark, topic))
    got = to_memory(stream, "fields", "complete", str(tmp_path / "c"))
    want = state.field_state(ev.normalize_messages(spark.read.parquet(topic)), ("timestamp", "event_id"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_dedup_stream(spark, time_ordered, tmp_path):
    schema = spark.read.parquet(time_ordered).schema
    source = spark.readStream.schema(schema).parquet(time_ordered)
    twice = source.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    got = to_memory(assembly.dedup_stream(twice), "dedup", "append", str(tmp_path / "c"))
    assert got.count() == got.select("event_id").distinct().count() == 1000


def test_sessions_equal_batch_up_to_the_watermark(spark, time_ordered, tmp_path):
    events = spark.read.parquet(time_ordered)
    source = spark.readStream.schema(events.schema).parquet(time_ordered)
    got = to_memory(assembly.session_stream(source), "sessions", "append", str(tmp_path / "c"))
    want = state.trip_sessions(events)
    closed = events.agg(F.timestamp_add("HOUR", F.lit(-1), F.max("event_ts"))).first()[0]
    emitted = {(r.trip_key, r.session_start.replace(tzinfo=None), r.events) for r in got.collect()}
    expected = {(r.trip_key, r.session_start, r.events) for r in want.collect() if r.session_end <= closed}
    assert emitted == expected and len(expected) > 500


def test_expiring_state(spark, tmp_path):
    """The processor emits the trips the aggregate form finds; state older than the limit is gone."""
    base = dt.datetime(2025, 1, 1, 10)
    kinds = ("trip_started", "trip_ended", "payment_processed")

    def write(folder, rows):
        data = [(k, json.dumps({"event_id": f"{k}-{t}", "trip_key": k, "event_type": t, "vendor_id": 1, "vehicle_id_h": "v",
                                "timestamp": (base + dt.timedelta(seconds=i)).isoformat(), "passenger_count": 2,
                                "fare_amount": 9.5})) for i, (k, t) in enumerate(rows)]
        spark.createDataFrame(data, "key string, value string").coalesce(1).write.mode("append").parquet(folder)

    folder, provider = str(tmp_path / "in"), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, expiry.ROCKSDB)
    write(folder, [("a", t) for t in kinds] + [("b", "trip_started"), ("b", "trip_ended")])
    events = ev.valid_events(ev.parse_messages(topics.read_message_files(spark, folder)))
    query = expiry.assembled_with_expiry(events, ttl_millis=4_000).writeStream.format("memory").queryName("expiring") \
        .outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    try:
        wait_for(query, lambda: spark.table("expiring").count() >= 1)
        time.sleep(6)
        write(folder, [("b", "payment_processed"), ("c", kinds[0]), ("c", kinds[1]), ("c", kinds[2])])
        wait_for(query, lambda: spark.table("expiring").count() >= 2)
        # b had two of its three events forgotten
        assert {(r.trip_key, r.fare_amount) for r in spark.table("expiring").collect()} == {("a", 9.5), ("c", 9.5)}
    finally:
        query.stop()
        spark.conf.set(provider, before)


BASE = dt.datetime(2025, 1, 1, 10)
KINDS = ("trip_started", "trip_ended", "payment_processed")


def event_rows(*events):
    """(trip, type, hours after the base[, fare]) as messages."""
    out = []
    for trip, kind, hours, *fare in events:
        body = {"event_id": f"{trip}-{kind}-{hours}", "trip_key": trip, "event_type": kind, "timestamp": (BASE + dt.timedelta(hours=hours)).isoformat()}
        if kind != "trip_deleted":
            body |= {"vendor_id": 1, "vehicle_id_h": "v", "pickup_zone_id": 1, "dropoff_zone_id": 2, "passenger_count": 2,
                     "fare_amount": fare[0] if fare else 9.5}
        out.append((trip, json.dumps(body)))
    return out


def feed(spark, folder, *batches):
    """One file per micro-batch."""
    for batch in batches:
        spark.createDataFrame(event_rows(*batch), "key string, value string").coalesce(1).write.mode("append").parquet(folder)


def assembled(spark, tmp_path, *batches, **options):
    """Feed one micro-batch after the other to a query that goes on from its checkpoint; what the table holds after each."""
    folder, table, seen = str(tmp_path / "in"), staging_table(str(tmp_path / "trips")), []
    for batch in batches:
        feed(spark, folder, batch)
        stats = assembly.LoopStats()
        run(assembly.start_assembly(topics.read_message_files(spark, folder), table, str(tmp_path / "c"), AS_OF, stats, **options))
        assert stats.ended.wait(60)
        seen.append({r.trip_key: (r.pickup_ts, r.fare_amount) for r in table.read(spark).collect()})
    return seen, stats


def whole(trip, hours, fare=9.5):
    return [(trip, kind, hours + i / 10, fare) for i, kind in enumerate(KINDS)]


def at(hours):
    return BASE + dt.timedelta(hours=hours)


def test_state_ends_in_event_time(spark, tmp_path):
    """A trip whose events lie more than the limit apart starts anew, in whatever order they come."""
    seen, _ = assembled(
        spark, tmp_path, [("a", KINDS[1], 1), ("a", KINDS[0], 0), *whole("b", 0)],
        [("a", KINDS[2], 8), ("c", KINDS[2], 7), ("c", KINDS[0], 5)],
        [*whole("a", 8.5, 7.0)[:2], ("c", KINDS[1], 2), *whole("b", 12, 3.0)], clock="event", delay="12 hours")
    assert seen[0] == {"b": (at(0), 9.5)} == seen[1]
    # the payment of a came too late for its first events and belongs to the later ones; c was never apart
    assert seen[2] == {"a": (at(8.5), 9.5), "b": (at(12), 3.0), "c": (at(5), 9.5)}


def test_state_stays_bounded(spark, tmp_path):
    """Trips of many days pass; state holds those of the last hours only."""
    batches = [[(f"t{n}-{day}", kind, 24 * day + n / 10) for n in range(10) for kind in KINDS[:2]] for day in range(6)]
    _, stats = assembled(spark, tmp_path, *batches, clock="event", delay="1 hour")
    # rows of list state: two events of ten trips, besides what the next watermark takes away
    assert 0 < stats.rows_in_state <= 2 * 2 * 10


def test_deleted_trip_starts_empty(spark, tmp_path):
    seen, _ = assembled(
        spark, tmp_path, [("a", KINDS[0], 0), ("a", KINDS[1], 1), ("b", KINDS[0], 0), ("b", KINDS[1], 1)],
        [("a", "trip_deleted", 2)], [("a", KINDS[2], 3), ("b", KINDS[2], 3)], [*whole("a", 4, 5.0)])
    assert seen[2] == {"b": (at(0), 9.5)} and seen[3] == {"a": (at(4), 5.0), "b": (at(0), 9.5)}


def test_deletion_counts_by_time_and_not_by_order(spark, tmp_path):
    """In one micro-batch, and after events that are later than it."""
    seen, _ = assembled(spark, tmp_path, [*whole("a", 0), ("a", "trip_deleted", 0.15), *whole("b", 0), ("b", "trip_deleted", 9)],
                        [("a", KINDS[0], 0.1), ("a", KINDS[1], 0.14)], [("a", KINDS[0], 0.3), ("a", KINDS[1], 0.4)])
    assert seen[0] == {} == seen[1] and seen[2] == {"a": (at(0.3), 9.5)}


def test_deletions_are_messages(spark):
    frame = spark.createDataFrame([("a", BASE)], "trip_key string, event_ts timestamp_ntz")
    parsed = ev.parse_messages(ev.deletion_messages(frame), controls=True).first()
    assert (parsed.reject_reason, parsed.trip_key, parsed.event_type, parsed.event_ts) == (None, "a", "trip_deleted", BASE)
    assert ev.parse_messages(ev.deletion_messages(frame)).first().reject_reason == "unknown_type"


def test_state_for_ever(spark, topic, tmp_path):
    table = staging_table(str(tmp_path / "trips"))
    run(assembly.start_assembly(topics.read_message_files(spark, topic, 1), table, str(tmp_path / "c"), AS_OF, ttl_millis=None))
    assert sorted(table.read(spark).collect()) == sorted(batch_result(spark, topic).collect())


def test_accepted_trips_are_not_kept_beside_the_table(spark, topic, tmp_path):
    table, known = staging_table(str(tmp_path / "trips")), Inputs(spark, SF_DIR).zones
    zones = spark.createDataFrame([(i, "b", "z", "s") for i in range(1, 80)], known.schema)
    run(assembly.start_assembly(topics.read_message_files(spark, topic, 1), table, str(tmp_path / "c"), AS_OF, zones=zones))
    kept = [p for p in (tmp_path / "trips" / "_rejects").glob("batch=*/reject_reason=*") if "HIVE_DEFAULT" in p.name]
    assert not kept and assembly.read_rejects(spark, table).count() > 0 and table.read(spark).count() > 0


def test_field_state_is_folded_in(spark, topic, tmp_path):
    """File by file, from a checkpoint and again from a new one: always the state of the batch form."""
    want = sorted(map(str, state.field_state(ev.normalize_messages(spark.read.parquet(topic)), ("timestamp", "event_id")).collect()))
    path, messages = str(tmp_path / "fields"), topics.read_message_files(spark, topic, 1)
    for checkpoint in ("c1", "c1", "c2"):
        run(fields.start_field_state(messages, path, str(tmp_path / checkpoint)))
        assert sorted(map(str, fields.field_store(messages, path).read(spark).collect())) == want


def test_field_state_writes_what_a_batch_changes_and_forgets(spark, tmp_path):
    folder, path, now = str(tmp_path / "in"), str(tmp_path / "fields"), [BASE]

    def fold(*batch):
        feed(spark, folder, batch)
        messages = topics.read_message_files(spark, folder)
        run(fields.start_field_state(messages, path, str(tmp_path / "c"), clock=lambda: now[0]))
        return {r.trip_key: (r.fare_amount, r.trip_started_timestamp) for r in fields.field_store(messages, path, clock=lambda: now[0]).read(spark).collect()}

    assert fold(*[(f"t{i}", KINDS[0], 0) for i in range(200)])["t7"] == ("9.5", at(0).isoformat())
    sizes = [p.stat().st_size for p in (tmp_path / "fields" / "runs").rglob("*.parquet")]
    now[0] = at(5)
    assert fold(("t7", KINDS[2], 1, 4.0))["t7"] == ("4.0", at(0).isoformat())
    run_ = max((tmp_path / "fields" / "runs").iterdir(), key=lambda p: p.stat().st_mtime)
    assert spark.read.parquet(str(run_)).count() == 1 and sum(sizes) > 0
    # six hours after their only message the other trips are gone, and a new message starts one empty
    now[0] = at(7)
    assert fold(("t8", KINDS[2], 7, 3.0)) == {"t7": ("4.0", at(0).isoformat()), "t8": ("3.0", None)}


def test_a_repeated_range_of_offsets_changes_nothing(spark, tmp_path):
    """Exactly once, across a query that starts over and files that overlap."""
    folder, path = str(tmp_path / "in"), str(tmp_path / "fields")

    def put(first, last):
        rows = [(*event_rows((f"t{n % 5}", KINDS[0], n, float(n)))[0], "trip-events", n % 2, n) for n in range(first, last)]
        spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset bigint").coalesce(1).write.mode("append").parquet(folder)

    def fold(checkpoint):
        messages = topics.read_message_files(spark, folder, 1, offsets=True)
        run(fields.start_field_state(messages, path, str(tmp_path / checkpoint)))
        store = fields.field_store(messages, path)
        state_ = {r.trip_key: r.fare_amount for r in store.read(spark).collect()}
        return state_, store.log.manifest(spark)["seq"], fields.OffsetLedger(f"{path}/_offsets").last(spark)

    put(0, 10)
    first = fold("c1")
    assert first == ({f"t{n}": f"{n + 5}.0" for n in range(5)}, 1, {("trip-events", 0): 8, ("trip-events", 1): 9})
    # a query without memory reads the same range again
    assert fold("c2") == first
    put(6, 13)
    state_, seq, last = fold("c2")
    assert seq == 2 and last == {("trip-events", 0): 12, ("trip-events", 1): 11}
    assert state_ == {"t0": "10.0", "t1": "11.0", "t2": "12.0", "t3": "8.0", "t4": "9.0"}


def wait_for(query, condition, seconds=60):
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        assert query.exception() is None, query.exception()
        if condition():
            return
        time.sleep(0.5)
    raise AssertionError("the stream produced nothing in time")


def test_trips_of_a_pack_share_the_calls_to_the_state_store():
    """The trips of a pack are loaded, stored and timed together, and each for itself emitted, ended and deleted."""
    calls, timers = [], []

    class Stored:
        value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

        def clear(self):
            calls.append("clear")
            self.value = None

    class Handle:
        def getValueState(self, name, schema):
            return Stored()

        def registerTimer(self, millis):
            timers.append(millis)

    class Times:
        def __init__(self, watermark=0):
            self.watermark = watermark

        def getCurrentWatermarkInMs(self):
            return self.watermark

    def event(trip, kind, second, fare=9.5):
        known = {"clock": second * 1_000_000, "event_type": kind, "event_ts": second * 1_000_000, "event_id": f"{trip}-{second}"}
        return 7, trip, json.dumps(known | dict.fromkeys(expiry.FIELDS) | {"fare_amount": fare}), None

    processor = expiry.TripAssembler(10_000)
    processor.init(Handle())
    rows = [event(f"t{n}", kind, n + i) for n in range(50) for i, kind in enumerate(KINDS)]
    got = list(processor.handleInputRows((7,), iter([*rows, event("t49", "trip_deleted", 60)]), Times()))
    assert [r.trip_key for r in got] == [f"t{n}" for n in range(49)] and calls == ["get", "update"]
    # the first trip ends ten seconds after its last event; the others are still known and a correction emits them
    assert timers == [12_001] and list(processor.handleExpiredTimer((7,), Times(12_001), None)) == [] and timers[1:] == [13_001]
    # JSON has no number that is none
    late = [event("t0", KINDS[2], 12, 1.0), event("t1", KINDS[2], 12, "NaN"), event("t49", KINDS[2], 55, 1.0)]
    (again,) = processor.handleInputRows((7,), iter(late), Times())
    assert again.trip_key == "t1" and again.fare_amount != again.fare_amount
    assert calls == ["get", "update"] * 3
    # in the end nothing is left
    assert list(processor.handleExpiredTimer((7,), Times(1_000_000), None)) == [] and calls[6:] == ["get", "clear"]
