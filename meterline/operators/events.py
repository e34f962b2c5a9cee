"""Trips to events and back to typed columns: decomposition, JSON, parsing, normalising."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions.hashing import event_id, hash_percent, iso_text
from meterline.functions.parsing import iso_timestamp
from meterline.functions.trips import duration_min
from meterline.schemas import CONTRACT_PAYLOAD, PARSED_EVENT_TYPES, TRIP_DELETED, TRIP_EVENT

# Seconds after pickup or dropoff at which each event happens.
ZONE_ENTERED_DELAY = 30
ZONE_EXITED_DELAY = 30
PAYMENT_DELAY = 60


def _later(ts: Column, seconds: int) -> Column:
    return F.timestamp_add("SECOND", F.lit(seconds), ts)


def _event(event_type: str, at: Column, **fields: Column) -> Column:
    """One event of the wide struct; fields of other types are NULL."""
    known = {"event_type": F.lit(event_type), "event_ts": at, **fields}
    own = [f for f in TRIP_EVENT.fields if f.name not in ("event_id", "trip_key", "timestamp", "vendor_id", "vehicle_id_h", "source")]
    values = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in own]
    return F.struct(at.alias("event_ts"), *values)


def trip_events(trips: DataFrame, base_time: Column | None = None) -> DataFrame:
    """Five events per trip, in time order ``event_ts``; ``base_time`` replaces the pickup time.

    One array expression per row and no shuffle; ids depend on trip and type only.
    """
    start = F.col("pickup_ts") if base_time is None else F.coalesce(base_time, F.col("pickup_ts"))
    end = F.col("dropoff_ts")
    events = F.array(
        _event("trip_started", start, pickup_zone_id=F.col("pu_zone_id"), passenger_count=F.col("passenger_count")),
        _event("zone_entered", _later(start, ZONE_ENTERED_DELAY), zone_id=F.col("pu_zone_id")),
        _event("trip_ended", end, dropoff_zone_id=F.col("do_zone_id"), trip_distance=F.col("trip_distance"),
               trip_duration_minutes=duration_min(F.col("pickup_ts"), end)),
        _event("zone_exited", _later(end, ZONE_EXITED_DELAY), zone_id=F.col("do_zone_id")),
        _event("payment_processed", _later(end, PAYMENT_DELAY), fare_amount=F.col("fare_amount"),
               tip_amount=F.col("tip_amount"), total_amount=F.col("total_amount"), payment_type=F.col("payment_type")),
    )
    rows = trips.select("trip_key", "vendor_id", "vehicle_id_h", F.explode(events).alias("e"))
    flat = rows.select("trip_key", "vendor_id", "vehicle_id_h", "e.*").withColumns({
        "event_id": event_id(F.col("trip_key"), F.col("event_type")),
        "timestamp": iso_text(F.col("event_ts")),
        "source": F.lit("stream"),
    })
    return flat.select(*TRIP_EVENT.names, "event_ts")


def events_json(events: DataFrame) -> DataFrame:
    """Topic messages: key and flat JSON with every field, absent ones as null."""
    body = F.to_json(F.struct(*TRIP_EVENT.names), {"ignoreNullFields": "false"})
    return events.select(F.col("trip_key").alias("key"), body.alias("value"))


def event_stats(validated: DataFrame) -> DataFrame:
    """Trips converted, trips skipped as invalid and events produced, from validated trips."""
    ok = F.size("failed_rules") == 0
    converted = F.count(F.when(ok, F.lit(1)))
    return validated.agg(
        converted.alias("trips_processed"), F.count(F.when(~ok, F.lit(1))).alias("trips_failed"),
        (converted * 5).alias("events_generated"),
    )


def late_events(events: DataFrame, late_pct: int = 3, delay_seconds: int = 600) -> DataFrame:
    """Arrival times for a replay: the events of ``late_pct`` percent of the trips arrive late.

    Late trips follow from their key, so a replay always delays the same ones.
    """
    late = hash_percent(F.col("trip_key")) < late_pct
    return events.withColumns({
        "is_late": late,
        "arrival_ts": F.when(late, _later(F.col("event_ts"), delay_seconds)).otherwise(F.col("event_ts")),
    })


def flatten_contract(nested: DataFrame) -> DataFrame:
    """Nested contract events to one row of columns; a value in the payload wins."""
    outer = [c for c in nested.columns if c != "payload" and c not in CONTRACT_PAYLOAD.names]
    inner = [f.name for f in nested.schema["payload"].dataType.fields]
    both = [c for c in nested.columns if c in inner]
    return nested.select(
        *outer, *[F.coalesce(f"payload.{c}", c).alias(c) if c in both else F.col(f"payload.{c}") for c in inner]
    )


def contract_events(trips: DataFrame) -> DataFrame:
    """Nested contract events of a trip: identity, passengers, fare, drop and tip."""
    def nested(event_type: str, at: Column, *fields: str) -> Column:
        values = [
            (F.col(f.name) if f.name in fields else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CONTRACT_PAYLOAD.fields
        ]
        return F.struct(F.lit(event_type).alias("event_type"), at.alias("event_ts"), F.struct(*values).alias("payload"))

    pickup, dropoff = F.col("pickup_ts"), F.col("dropoff_ts")
    events = F.array(
        nested("IDENTITY", pickup, "vendor_id", "vehicle_id_h", "pickup_ts", "pu_zone_id", "do_zone_id"),
        nested("PASSENGERS", _later(pickup, 10), "passenger_count"),
        nested("FARE", dropoff, "fare_amount", "total_amount", "payment_type", "trip_distance"),
        nested("DROP", dropoff, "dropoff_ts", "do_zone_id", "total_amount"),
        nested("TIP", _later(dropoff, 60), "tip_amount"),
    )
    return trips.select("trip_key", F.col("vehicle_id_h").alias("_vehicle"), F.explode(events).alias("e")).select(
        F.col("e.event_type"), F.lit("1").alias("event_version"), F.col("e.event_ts"), "trip_key",
        F.col("_vehicle").alias("vehicle_id_h"), "e.payload",
    )


def deletion_messages(trips: DataFrame, at: str = "event_ts") -> DataFrame:
    """Control messages that make the assembly forget trips up to a time."""
    key = F.col("trip_key")
    value = F.to_json(F.struct(
        F.concat(F.lit("del-"), key).alias("event_id"), key, F.lit(TRIP_DELETED).alias("event_type"), iso_text(F.col(at)).alias("timestamp")))
    return trips.select(key.alias("key"), value.alias("value"))


def parse_messages(messages: DataFrame, controls: bool = False) -> DataFrame:
    """Typed columns of JSON messages, and ``reject_reason`` for those that are no event.

    Reasons in order: not JSON, unknown type, a required field missing, bad time. With ``controls``, deletions are known, too;
    they need no vehicle or vendor.
    """
    # a generator, so that the text is parsed once and not once per field and filter
    body = F.from_json("value", TRIP_EVENT, {"mode": "PERMISSIVE"})
    others = [c for c in messages.columns if c != "value"]
    wide = messages.select(*others, "value", F.inline(F.array(body))).withColumn("event_ts", iso_timestamp(F.col("timestamp")))
    empty = F.coalesce("event_type", "trip_key", "event_id", "timestamp").isNull()
    missing = F.lit(False)
    deletion = F.coalesce(F.col("event_type") == TRIP_DELETED, F.lit(False)) if controls else F.lit(False)
    for name in ("event_id", "trip_key", "vendor_id", "vehicle_id_h", "timestamp"):
        absent = F.col(name).isNull()
        missing = missing | (absent & ~deletion if name in ("vendor_id", "vehicle_id_h") else absent)
    reason = (
        F.when(empty, "malformed")
        .when(~F.coalesce(F.col("event_type").isin(*PARSED_EVENT_TYPES), F.lit(False)) & ~deletion, "unknown_type")
        .when(missing, "field_missing")
        .when(F.col("event_ts").isNull(), "bad_timestamp")
    )
    return wide.withColumn("reject_reason", reason)


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason is null").drop("reject_reason", "value")


def rejected_messages(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason is not null")


NORMALIZED_FIELDS = (
    "event_id", "vendor_id", "vehicle_id_h", "pickup_zone_id", "dropoff_zone_id", "passenger_count",
    "fare_amount", "tip_amount", "total_amount", "payment_type", "distance_km", "duration_min", "avg_speed_kmh",
)
_NORMALIZED_SCHEMA = (
    "trip_key string, event_type string, timestamp string, event_id string, vendor_id string, vehicle_id_h string, "
    "pickup_zone_id string, dropoff_zone_id string, passenger_count string, fare_amount string, tip_amount string, "
    "total_amount string, payment_type string, distance_km string, duration_min string, avg_speed_kmh string"
)


def normalize_messages(messages: DataFrame) -> DataFrame:
    """Any event with a key and a type, as 16 text fields; the time is ISO text or NULL with a flag.

    The type is not restricted here, unlike in :func:`parse_messages`.
    """
    others = [c for c in messages.columns if c not in ("key", "value")]
    raw = messages.select(*others, F.inline(F.array(F.from_json("value", _NORMALIZED_SCHEMA))))
    present = F.coalesce((F.col("trip_key") != "") & (F.col("event_type") != ""), F.lit(False))
    event_ts = iso_timestamp(F.col("timestamp"))
    return raw.where(present).select(
        *others, "trip_key", "event_type", iso_text(event_ts).alias("timestamp"), *NORMALIZED_FIELDS,
        event_ts.isNull().alias("bad_timestamp"),
    )


def event_type_counts(events: DataFrame, *labels: str) -> DataFrame:
    return events.groupBy("event_type", *labels).agg(F.count("*").alias("events"))
