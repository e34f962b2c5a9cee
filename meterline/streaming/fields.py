"""Raw field state of trips, kept in a change log: a micro-batch reads and writes the trips it mentions and no others.

The stored row of a trip holds the latest value of every field with the rank of its event, so batches may come in any order and
twice. A trip that no message has touched for ``STATE_TTL`` is forgotten: readers do not see it, a later message starts it
empty, and merges of the log drop it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from meterline.operators import state
from meterline.operators.events import normalize_messages
from meterline.operators.staging import timestamp_literal
from meterline.schemas import EVENT_BITS, STATE_TTL
from meterline.sources.changelog import KeyedLog
from meterline.sources.offsets import COLUMNS, OffsetLedger
from meterline.streaming.deliveries import delivery_id

Clock = Callable[[], dt.datetime]


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


def _ranked(normalized: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per trip: each field as ``(rank, value)`` of the latest event that has it."""
    def latest(value: str, has: Column) -> Column:
        return F.max(F.when(has, F.struct(F.struct(*order).alias("rank"), F.col(value).alias("value"))))
    columns = {f: latest(f, F.col(f).isNotNull()) for f in state.FIELD_STATE_FIELDS}
    for event_type in EVENT_BITS:
        own = F.col("event_type") == event_type
        for name in ("timestamp", "event_id"):
            columns[f"{event_type}_{name}"] = latest(name, own & F.col(name).isNotNull())
    return normalized.groupBy("trip_key").agg(*[c.alias(n) for n, c in columns.items()])


def _nullable(kind: T.DataType) -> T.DataType:
    """The type as a file has it: every field may be null."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    return kind


class FieldStore:
    """The stored field state below a path. ``clock`` tells when messages arrive."""

    def __init__(self, path: str, normalized: DataFrame, order: Sequence[str] = ("timestamp", "event_id"), clock: Clock = utc_now, ttl: str = STATE_TTL):
        self.order, self.clock, self.ttl = tuple(order), clock, ttl
        schema = _nullable(T.StructType([*_ranked(normalized, order).schema.fields, T.StructField("touched_at", T.TimestampNTZType())]))
        self.fields = [f.name for f in schema.fields if f.name not in ("trip_key", "touched_at")]
        self.log = KeyedLog(path, schema, ("trip_key",), alive=lambda: F.col("touched_at") >= timestamp_literal(self.clock()) - F.expr(f"INTERVAL '{self.ttl}'"))

    def update(self, normalized: DataFrame, batch_id: str) -> int:
        """Fold a batch in; returns the number of trips it changed."""
        spark = normalized.sparkSession
        batch = _ranked(normalized, self.order).withColumn("touched_at", timestamp_literal(self.clock())).persist()
        try:
            known = self.log.of_keys(spark, batch.select("trip_key")).unionByName(batch)
            changed = known.groupBy("trip_key").agg(*[F.max(c).alias(c) for c in (*self.fields, "touched_at")])
            return self.log.append(spark, changed, batch_id)
        finally:
            batch.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        """Latest value per field of every trip that has not been forgotten."""
        return self.log.read(spark).select("trip_key", *[F.col(f"{f}.value").alias(f) for f in self.fields])


def start_field_state(messages: DataFrame, path: str, checkpoint: str, order: Sequence[str] = ("timestamp", "event_id"),
                      clock: Clock = utc_now, **trigger: object) -> StreamingQuery:
    """Keep the latest value per field of every trip in a change log; see :func:`field_store` for reading it.

    Messages that come with the offsets of their topic are taken once, whichever query brings them: the ledger of offsets moves
    after the store has taken a batch, and a batch that is repeated in between finds its delivery done.
    """
    store = field_store(messages, path, order, clock)
    ledger = OffsetLedger(f"{path}/_offsets") if set(COLUMNS) <= set(messages.columns) else None

    def fold(batch: DataFrame, epoch: int) -> None:
        name = delivery_id(batch, epoch)
        if ledger is None:
            store.update(batch, name)
            return
        fresh = ledger.fresh(batch).persist()
        try:
            if not fresh.isEmpty():
                store.update(fresh, name)
                ledger.advance(fresh, name)
        finally:
            fresh.unpersist()

    return (
        normalize_messages(messages).writeStream
        .option("checkpointLocation", checkpoint)
        .foreachBatch(fold)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def field_store(messages: DataFrame, path: str, order: Sequence[str] = ("timestamp", "event_id"), clock: Clock = utc_now) -> FieldStore:
    return FieldStore(path, normalize_messages(messages), order, clock)
