"""Trip state that ends a fixed time after a trip's last event, and on demand.

One processor holds what is known of a trip: the latest event of each type. Time is that of arrival, of which every micro-batch
has one, or that of the events. A gap of more than the time to live between events ends a trip's state, and an event after it
starts the trip anew; timers free state once the watermark shows that nothing can extend it.

Events are folded in as they come and none is kept twice, so a busy trip costs no more memory than a quiet one. By the time of
events the result does not depend on their order inside what the watermark allows: events join the stretches of time they
touch, and stretches that an event connects become one. A deletion at some time forgets the events up to then. The latest event
of a type is either later than the deletion or all of that type are forgotten, so a deletion, too, may come in any order.

Every call from Python to the state store costs more than the work on a trip. So trips are kept in packs by the hash of their key:
a pack is read, written and timed once for all of its trips that a micro-batch brings. A pack holds the live trips only, a few
until many thousands are under way at once; it is rewritten when one of its trips changes.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator
from typing import NamedTuple

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterline.operators.state import REQUIRED_MASK
from meterline.schemas import EVENT_BITS, TRIP_DELETED

# the processor travels to the executors with its code, which need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TTL_MILLIS = 6 * 60 * 60 * 1000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

FIELDS = (
    "vendor_id", "vehicle_id_h", "pickup_zone_id", "passenger_count", "dropoff_zone_id", "trip_distance", "fare_amount",
    "tip_amount", "total_amount", "payment_type",
)
#: Into how many packs trips are dealt; a query keeps the number of its first start.
PACKS = 16_384
#: The trips of a pack as JSON, each with its deletion and its stretches, and the earliest timer of the pack.
_STATE = "trips string, due bigint"
#: Times are microseconds here and in state.
_EMITTED = (
    "trip_key string, mask int, vendor_id int, vehicle_id_h string, started_ts bigint, "
    "pickup_zone_id int, passenger_count int, ended_ts bigint, dropoff_zone_id int, trip_distance double, "
    "paid_ts bigint, fare_amount double, tip_amount double, total_amount double, payment_type int"
)
_NAMES = ("event_ts", "event_id", *FIELDS)
_DOUBLES = [_NAMES.index(name) for name in ("trip_distance", "fare_amount", "tip_amount", "total_amount")]


def _rank(event: list) -> tuple:
    """By time and id, then by the values as a struct orders them."""
    return tuple((v is not None, v) for v in event)


class Stretch:
    """Events of a trip without a longer gap: first and last time, and the latest event of each type."""

    def __init__(self, first: int, last: int, types: dict[str, list]):
        self.first, self.last, self.types = first, last, types

    def take(self, other: Stretch) -> None:
        self.first, self.last = min(self.first, other.first), max(self.last, other.last)
        for kind, event in other.types.items():
            known = self.types.get(kind)
            if known is None or _rank(event) > _rank(known):
                self.types[kind] = event

    @property
    def mask(self) -> int:
        return sum(1 << EVENT_BITS[kind] for kind in self.types)

    @property
    def complete(self) -> bool:
        return self.mask & REQUIRED_MASK == REQUIRED_MASK


class Deletion(NamedTuple):
    upto: int  # in the time of events
    last: int  # when it came


class Trip:
    """What is known of a trip, and its latest complete events before this micro-batch."""

    def __init__(self, deletion: list | None = None, stretches: Iterable[list] = ()):
        self.deletion = deletion and Deletion(*deletion)
        self.stretches = [Stretch(*s) for s in stretches]
        latest = self.latest()
        self.before = latest and dict(latest.types)

    def stored(self) -> list:
        return [self.deletion, [[s.first, s.last, s.types] for s in self.stretches]]

    def latest(self) -> Stretch | None:
        return max((s for s in self.stretches if s.complete), key=lambda s: s.last, default=None)

    def join(self, new: Stretch, gap: int) -> None:
        apart = []
        for s in self.stretches:
            if max(s.first, new.first) - min(s.last, new.last) <= gap:
                new.take(s)
            else:
                apart.append(s)
        self.stretches = [*apart, new]

    def delete(self, upto: int, last: int) -> None:
        known = self.deletion
        self.deletion = Deletion(upto, last) if known is None else Deletion(max(known.upto, upto), max(known.last, last))

    def forget_deleted(self) -> None:
        if self.deletion:
            for s in self.stretches:
                s.types = {kind: e for kind, e in s.types.items() if e[0] > self.deletion.upto}
            self.stretches = [s for s in self.stretches if s.types]


class TripAssembler(StatefulProcessor):
    """Emits the latest complete stretch of a trip whenever events have changed it. Trips come and stay in packs."""

    def __init__(self, ttl_millis: int = TTL_MILLIS):
        self.gap = ttl_millis * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pack = handle.getValueState("pack", _STATE)

    def _load(self) -> tuple[dict[str, list], int | None]:
        stored = self.pack.get()
        return ({}, None) if stored is None else (json.loads(stored[0]), stored[1])

    def _save(self, trips: dict[str, list], due: int | None) -> None:
        """Store the trips of a pack; a timer waits for the first of them to end, and ``due`` is the earliest that waits already."""
        if not trips:
            self.pack.clear()
            return
        ends = self._ends(min(last for deletion, stretches in trips.values() for last in (*[s[1] for s in stretches], *([deletion[1]] if deletion else []))))
        if due is None or ends < due:
            self.handle.registerTimer(ends)
            due = ends
        self.pack.update((json.dumps(trips), due))

    def _ends(self, last: int) -> int:
        """The watermark, in milliseconds, from which nothing can extend a stretch."""
        return (last + self.gap) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored, due = self._load()
        touched: dict[str, Trip] = {}
        for _, trip_key, text, _ in rows:
            clock, kind, *event = json.loads(text).values()
            for i in _DOUBLES:
                if isinstance(event[i], str):  # not a number, or infinite
                    event[i] = float(event[i])
            trip = touched.get(trip_key)
            if trip is None:
                trip = touched[trip_key] = Trip(*stored.get(trip_key, ()))
            if kind == TRIP_DELETED:
                trip.delete(event[0], clock)
            else:
                trip.join(Stretch(clock, clock, {kind: event}), self.gap)
        for trip_key, trip in touched.items():
            trip.forget_deleted()
            if trip.deletion or trip.stretches:
                stored[trip_key] = trip.stored()
            else:
                stored.pop(trip_key, None)
        self._save(stored, due)
        for trip_key, trip in touched.items():
            latest = trip.latest()
            if latest and latest.types != trip.before:
                yield self._trip(trip_key, latest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        stored, due = self._load()
        kept = {}
        for trip_key, (deletion, stretches) in stored.items():
            deletion = deletion if deletion and self._ends(deletion[1]) > now else None
            stretches = [s for s in stretches if self._ends(s[1]) > now]
            if deletion or stretches:
                kept[trip_key] = [deletion, stretches]
        self._save(kept, due if due is not None and due > now else None)
        yield from ()

    @staticmethod
    def _trip(key: str, s: Stretch) -> Row:
        newest = dict(zip(_NAMES, max(s.types.values(), key=_rank), strict=True))
        started, ended, paid = (dict(zip(_NAMES, s.types[t], strict=True)) for t in ("trip_started", "trip_ended", "payment_processed"))
        return Row(
            trip_key=key, mask=s.mask, vendor_id=newest["vendor_id"], vehicle_id_h=newest["vehicle_id_h"],
            started_ts=started["event_ts"], pickup_zone_id=started["pickup_zone_id"], passenger_count=started["passenger_count"],
            ended_ts=ended["event_ts"], dropoff_zone_id=ended["dropoff_zone_id"], trip_distance=ended["trip_distance"],
            paid_ts=paid["event_ts"], **{c: paid[c] for c in ("fare_amount", "tip_amount", "total_amount", "payment_type")},
        )

    def close(self) -> None:
        pass


def assembled_with_expiry(events: DataFrame, ttl_millis: int = TTL_MILLIS, clock: str = "arrival", delay: str = "6 hours", packs: int = PACKS) -> DataFrame:
    """Complete trips of a stream of parsed events and deletions, one flat row each; needs the RocksDB state store.

    With the ``event`` clock, events more than ``delay`` behind the latest are dropped, as the query's progress reports.
    """
    at = {"arrival": (F.current_timestamp(), "0 seconds"), "event": (F.col("event_ts").cast("timestamp"), delay)}
    if clock not in at:
        raise ValueError(f"unknown clock {clock!r}")
    timed = events.withColumn("at", at[clock][0]).withWatermark("at", at[clock][1])
    known = F.struct(F.unix_micros("at").alias("clock"), "event_type", F.unix_micros(F.col("event_ts").cast("timestamp")).alias("event_ts"), *_NAMES[1:])
    # one text per event: rows come to Python value by value. The processor takes the columns by place
    rows = timed.select(
        F.pmod(F.xxhash64("trip_key"), F.lit(packs)).alias("pack"), "trip_key", F.to_json(known, {"ignoreNullFields": "false"}).alias("event"), "at")
    flat = rows.groupBy("pack").transformWithState(
        statefulProcessor=TripAssembler(ttl_millis), outputStructType=_EMITTED, outputMode="Update", timeMode="EventTime",
    )
    return flat.withColumns({c: F.timestamp_micros(c).cast("timestamp_ntz") for c in ("started_ts", "ended_ts", "paid_ts")})


def as_state(flat: DataFrame) -> DataFrame:
    """The flat rows in the form of :func:`meterline.operators.state.trip_state`, as far as complete trips need it."""
    return flat.select(
        "trip_key", "mask", F.struct("vendor_id", "vehicle_id_h").alias("latest"),
        F.struct(F.col("started_ts").alias("event_ts"), "pickup_zone_id", "passenger_count").alias("trip_started"),
        F.struct(F.col("ended_ts").alias("event_ts"), "dropoff_zone_id", "trip_distance").alias("trip_ended"),
        F.struct(F.col("paid_ts").alias("event_ts"), "fare_amount", "tip_amount", "total_amount", "payment_type").alias("payment_processed"),
    )
