"""Partial-trip state as aggregates, the same in batch and in streaming queries.

Later arrival wins; arrival order is given by ``order`` columns (event time and id by default), so
that batch and stream agree. All state comes from mergeable aggregates: events of a busy trip are
combined in the tasks that read them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.functions.parsing import safe_float, safe_int
from meterline.operators.staging import timestamp_literal
from meterline.schemas import COMPLETE_TRIP, EVENT_BITS, PARSED_EVENT_TYPES, REQUIRED_EVENT_TYPES, STATE_TTL

ORDER = ("event_ts", "event_id")
REQUIRED_MASK = sum(1 << EVENT_BITS[t] for t in REQUIRED_EVENT_TYPES)
FIELD_STATE_FIELDS = (
    "vendor_id", "vehicle_id_h", "pickup_zone_id", "dropoff_zone_id", "passenger_count", "fare_amount",
    "tip_amount", "total_amount", "payment_type", "distance_km", "duration_min", "avg_speed_kmh",
)
_KEPT = {
    "trip_started": ("pickup_zone_id", "passenger_count"),
    "trip_ended": ("dropoff_zone_id", "trip_distance"),
    "payment_processed": ("fare_amount", "tip_amount", "total_amount", "payment_type"),
    "zone_entered": ("zone_id",),
    "zone_exited": ("zone_id",),
}


def mask_bit() -> Column:
    """Bit value of the row's event type, 0 for an unknown one."""
    bit = F.lit(0)
    for event_type, position in EVENT_BITS.items():
        bit = F.when(F.col("event_type") == event_type, 1 << position).otherwise(bit)
    return bit


def is_complete_mask(mask: Column) -> Column:
    return mask.bitwiseAND(F.lit(REQUIRED_MASK)) == REQUIRED_MASK


def missing_types(mask: Column) -> Column:
    """Required event types without their bit in the mask."""
    return F.array_compact(F.array(*[
        F.when(mask.bitwiseAND(F.lit(1 << EVENT_BITS[t])) == 0, F.lit(t)) for t in REQUIRED_EVENT_TYPES
    ]))


def event_state(events: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Latest event per trip and type."""
    rest = [c for c in events.columns if c not in ("trip_key", "event_type", *order)]
    latest = events.groupBy("trip_key", "event_type").agg(F.max(F.struct(*order, *rest)).alias("_e"))
    return latest.select("trip_key", "event_type", "_e.*")


def trip_state(events: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """One row per trip: type mask and the latest event of each type, as a struct column each."""
    newest = F.max(F.struct(*order, "vendor_id", "vehicle_id_h"))
    per_type = [
        F.max(F.when(F.col("event_type") == t, F.struct(*order, F.col("timestamp").alias("at"), *_KEPT[t]))).alias(t)
        for t in PARSED_EVENT_TYPES
    ]
    return events.groupBy("trip_key").agg(F.bit_or(mask_bit()).alias("mask"), newest.alias("latest"), *per_type)


def complete_trips(state: DataFrame) -> DataFrame:
    """Trips with every required type, judged by the presence of their events."""
    present = F.lit(True)
    for event_type in REQUIRED_EVENT_TYPES:
        present = present & F.col(event_type).isNotNull()
    return state.where(present)


def complete_by_mask(state: DataFrame) -> DataFrame:
    return state.where(is_complete_mask(F.col("mask")))


def missing_events(state: DataFrame) -> DataFrame:
    """Open trips with the required types they wait for."""
    return state.where(~is_complete_mask(F.col("mask"))).select("trip_key", missing_types(F.col("mask")).alias("missing"))


def partial_trip_count(state: DataFrame) -> DataFrame:
    return state.agg(F.count(F.when(~is_complete_mask(F.col("mask")), F.lit(1))).alias("open_trips"))


def _text(event_type: str, field: str) -> Column:
    """Snapshot text of a field: ``None`` when its event came without it, NULL when no event came."""
    value = F.col(f"{event_type}.{field}").cast("string")
    return F.when(F.col(event_type).isNotNull(), F.coalesce(value, F.lit("None")))


def trip_snapshots(state: DataFrame) -> DataFrame:
    return state.select(
        "trip_key",
        F.col("latest.vendor_id").cast("string").alias("vendor_id"),
        _text("payment_processed", "fare_amount").alias("fare_amount"),
        _text("trip_started", "passenger_count").alias("passenger_count"),
        _text("payment_processed", "tip_amount").alias("tip_amount"),
        _text("payment_processed", "total_amount").alias("total_amount"),
        *[F.col(f"{t}.at").alias(f"{t}_timestamp") for t in PARSED_EVENT_TYPES],
    )


def build_trips(snapshots: DataFrame) -> DataFrame:
    """Six trip fields from snapshot text; missing or malformed text becomes 0."""
    return snapshots.select(
        "trip_key",
        safe_int(F.col("vendor_id")).alias("vendor_id"),
        safe_float(F.col("fare_amount")).alias("fare_amount"),
        safe_int(F.col("passenger_count")).alias("passenger_count"),
        safe_float(F.col("tip_amount")).alias("tip_amount"),
        safe_float(F.col("total_amount")).alias("total_amount"),
    )


def assembled_trips(state: DataFrame) -> DataFrame:
    return build_trips(trip_snapshots(complete_by_mask(state)))


def assembled_trips_full(state: DataFrame, as_of, source: str = "stream") -> DataFrame:
    """Staging rows of complete trips, with the times, zones, vehicle and distance of their events."""
    started, ended, paid = "trip_started", "trip_ended", "payment_processed"
    now = timestamp_literal(as_of)
    values = {
        "trip_key": F.col("trip_key"),
        "vendor_id": F.coalesce("latest.vendor_id", F.lit(0)),
        "pickup_ts": F.col(f"{started}.event_ts"),
        "dropoff_ts": F.col(f"{ended}.event_ts"),
        "pu_zone_id": F.col(f"{started}.pickup_zone_id"),
        "do_zone_id": F.col(f"{ended}.dropoff_zone_id"),
        "passenger_count": F.coalesce(f"{started}.passenger_count", F.lit(0)),
        "trip_distance": F.col(f"{ended}.trip_distance"),
        "fare_amount": F.coalesce(f"{paid}.fare_amount", F.lit(0.0)),
        "tip_amount": F.coalesce(f"{paid}.tip_amount", F.lit(0.0)),
        "total_amount": F.coalesce(f"{paid}.total_amount", F.lit(0.0)),
        "payment_type": F.col(f"{paid}.payment_type"),
        "vehicle_id_h": F.col("latest.vehicle_id_h"),
        "source": F.lit(source), "created_at": now, "updated_at": now,
    }
    return complete_by_mask(state).select(*[values[f.name].cast(f.dataType).alias(f.name) for f in COMPLETE_TRIP.fields])


def field_state(normalized: DataFrame, order: Sequence[str]) -> DataFrame:
    """Latest non-NULL value per field, and time and id of the latest event of each type."""
    rank = F.struct(*order)
    fields = [F.max_by(f, F.when(F.col(f).isNotNull(), rank)).alias(f) for f in FIELD_STATE_FIELDS]
    marks = []
    for event_type in EVENT_BITS:
        own = F.col("event_type") == event_type
        has_time = own & F.col("timestamp").isNotNull()
        marks.append(F.max_by("timestamp", F.when(has_time, rank)).alias(f"{event_type}_timestamp"))
        has_id = own & F.col("event_id").isNotNull()
        marks.append(F.max_by("event_id", F.when(has_id, rank)).alias(f"{event_type}_event_id"))
    return normalized.groupBy("trip_key").agg(*fields, *marks)


def trip_sessions(events: DataFrame, ts: str = "event_ts", gap: str = STATE_TTL) -> DataFrame:
    """State lifetimes in event time: a trip's state ends ``gap`` after its last event.

    Events of one trip in one ``gap``-wide slot of time are always in one session, so they are
    combined where they are read. What is ordered per trip is its slots, whose number depends on
    the time covered and not on the events of a busy trip.
    """
    length = F.expr(f"INTERVAL '{gap}'")
    slots = events.groupBy("trip_key", F.window(ts, gap)["start"].alias("slot")).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"), F.count("*").alias("n"), F.bit_or(mask_bit()).alias("bits"),
    )
    in_time = Window.partitionBy("trip_key").orderBy("slot")
    is_new = F.coalesce(F.col("first") > F.lag("last").over(in_time) + length, F.lit(False))
    numbered = slots.withColumn("is_new", is_new.cast("int")).withColumn("session", F.sum("is_new").over(in_time))
    return numbered.groupBy("trip_key", "session").agg(
        F.min("first").alias("session_start"), (F.max("last") + length).alias("session_end"),
        F.sum("n").alias("events"), is_complete_mask(F.bit_or("bits")).alias("complete"),
    ).drop("session")


def dedup_events(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per event id; copies of an event are equal, so any may stay."""
    return events.dropDuplicates([key])


def assembly_stats(messages_parsed: DataFrame, order: Sequence[str], commit_every: int = 500) -> DataFrame:
    """What the record-by-record loop reports: events read, trips emitted, offset commits.

    A trip is emitted at the event that completes it and at each later one. The completing
    position is an aggregate per trip; events then meet one row per trip in a join whose busy keys
    the runtime can split.
    """
    valid = messages_parsed.where("reject_reason is null")
    firsts = valid.groupBy("trip_key").agg(*[
        F.min(F.when(F.col("event_type") == t, F.struct(*order))).alias(t) for t in REQUIRED_EVENT_TYPES
    ])
    done = firsts
    for event_type in REQUIRED_EVENT_TYPES:
        done = done.where(F.col(event_type).isNotNull())
    done = done.select("trip_key", F.greatest(*REQUIRED_EVENT_TYPES).alias("completed_at"))
    emitted = valid.join(done, "trip_key").where(F.struct(*order) >= F.col("completed_at"))
    emissions = emitted.agg(F.count("*")).scalar()
    return messages_parsed.agg(F.count("*").alias("events")).select(
        "events", emissions.alias("trips_completed"), F.ceil(F.col("events") / commit_every).alias("commits"),
    )
