"""Event streams to trips: parse, keep state, upsert completed trips; raw field state; de-duplication.

Trips are assembled by the processor of :mod:`meterline.streaming.expiry`, whose state ends; without a time to live the batch
aggregates of :mod:`meterline.operators.state` run in update mode and keep every trip. Progress lives in the checkpoint, and
the sink upserts by key, so a restarted query repeats at most one micro-batch without effect.
"""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager
from threading import Event, Thread

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from meterline.operators import staging, state
from meterline.operators.events import normalize_messages, parse_messages, valid_events
from meterline.schemas import STATE_TTL
from meterline.sources.store import child_names, remove_path
from meterline.sources.tables import KeyedTable
from meterline.streaming import expiry
from meterline.streaming.deliveries import delivery_id

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def assembled_stream(messages: DataFrame, as_of: dt.datetime, ttl_millis: int | None = None, clock: str = "arrival", delay: str = STATE_TTL) -> DataFrame:
    """Complete trips of a message stream as staging rows; later events of a trip emit it again.

    With a time to live, a trip's state ends that long after its last event by the given clock, and deletions among the messages
    clear it; without, it stays.
    """
    events = valid_events(parse_messages(messages, controls=ttl_millis is not None))
    if ttl_millis is None:
        return state.assembled_trips_full(state.trip_state(events), as_of)
    return state.assembled_trips_full(expiry.as_state(expiry.assembled_with_expiry(events, ttl_millis, clock, delay)), as_of)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A setting for what starts inside; a query keeps the settings of its start."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def field_state_stream(messages: DataFrame, order: tuple[str, ...] = ("timestamp", "event_id")) -> DataFrame:
    """Latest value by ``order`` per field of every trip with events."""
    return state.field_state(normalize_messages(messages), order)


def with_event_watermark(events: DataFrame, delay: str, ts: str = "event_ts") -> DataFrame:
    """Watermarks need a zoned type; the session time zone is UTC."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def dedup_stream(events: DataFrame, delay: str = STATE_TTL) -> DataFrame:
    """First copy of each event id; ids are forgotten once the watermark has passed."""
    return with_event_watermark(events, delay).dropDuplicatesWithinWatermark(["event_id"])


def session_stream(events: DataFrame, delay: str = "1 hour", gap: str = STATE_TTL) -> DataFrame:
    """Trip sessions, emitted when the watermark passes their end; state is bounded by the delay."""
    sessions = with_event_watermark(events, delay).groupBy("trip_key", F.session_window("event_ts", gap).alias("session")).agg(
        F.count("*").alias("events"), F.bit_or(state.mask_bit()).alias("mask"),
    )
    return sessions.select(
        "trip_key", F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"),
        "events", state.is_complete_mask(F.col("mask")).alias("complete"),
    )


def rejects_path(table: KeyedTable, name: str | None = None) -> str:
    """The folder of all rejects, or that of one micro-batch."""
    return f"{table.path}/_rejects" + (f"/batch={name}" if name else "")


def _accepted(batch: DataFrame, table: KeyedTable, zones: DataFrame, name: str) -> DataFrame:
    """The good rows of a micro-batch, which is judged and written once; the others stay with their reason."""
    judged = rejects_path(table, name)
    rows = staging.judge(batch, zones)
    rows.write.mode("overwrite").partitionBy("reject_reason").parquet(judged)
    return zones.sparkSession.read.schema(rows.schema).parquet(judged).where("reject_reason is null").drop("reject_reason")


def read_rejects(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """Rejected trips of all micro-batches with their reason; a trip judged again appears once per judgement."""
    if not any(n.startswith("batch=") for n in child_names(spark, rejects_path(table))):
        return spark.createDataFrame([], T.StructType([*table.schema.fields, T.StructField("reject_reason", T.StringType())]))
    rows = spark.read.option("basePath", rejects_path(table)).parquet(f"{rejects_path(table)}/batch=*").drop("batch")
    return rows.where("reject_reason is not null and reject_reason <> '__HIVE_DEFAULT_PARTITION__'")


class LoopStats(StreamingQueryListener):
    """Messages read and micro-batches with data of one query, and the trips its sink took, over its whole run.

    Reports are added as they come; the list a query keeps holds only the latest of them. The listener goes when its query ends.
    """

    def __init__(self, spark: SparkSession | None = None) -> None:
        self.spark = spark
        self.events = self.commits = self.trips = self.late = 0
        self.rows_in_state = 0
        self.query_id: str | None = None
        self.ended = Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) != self.query_id:
            return
        if event.progress.numInputRows:
            self.events += event.progress.numInputRows
            self.commits += 1
        for operator in event.progress.stateOperators:
            self.rows_in_state = operator.numRowsTotal
            self.late += operator.numRowsDroppedByWatermark

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.ended.set()
            if self.spark:
                # not from inside its own call
                Thread(target=self.spark.streams.removeListener, args=(self,), daemon=True).start()


def start_assembly(messages: DataFrame, table: KeyedTable, checkpoint: str, as_of: dt.datetime,
                   stats: LoopStats | None = None, zones: DataFrame | None = None, ttl_millis: int | None = expiry.TTL_MILLIS,
                   clock: str = "arrival", delay: str = STATE_TTL, **trigger: object) -> StreamingQuery:
    """Assemble trips from ``messages`` and upsert them into ``table``; ``stats`` is counted up on the way.

    The state of a trip ends ``ttl_millis`` after its last event: by the time of arrival, or with ``clock="event"`` by the
    times of the events, of which those more than ``delay`` behind are dropped and counted. Deletions clear it.
    ``None`` keeps state for ever and knows no deletions.

    With ``zones``, trips that break a rule or name an unknown zone are kept out of the table and written with
    their reason to ``rejects_path``; a later correction of such a trip is judged again.

    A stateful query runs without adaptive execution. Only its own micro-batch does: the merge
    with the table runs in the caller's session, where skewed days are still split.
    """
    spark = messages.sparkSession

    def upsert(batch: DataFrame, epoch: int) -> None:
        name = delivery_id(batch, epoch)
        if stats:
            stats.query_id = name.rpartition("-")[0]
        taken = table.upsert(spark, batch if zones is None else _accepted(batch, table, zones, name), name)
        if zones is not None:
            # accepted trips are in the table now
            remove_path(spark, f"{rejects_path(table, name)}/reject_reason=__HIVE_DEFAULT_PARTITION__")
        if stats:
            stats.trips += taken

    if stats:
        stats.spark = spark
        spark.streams.addListener(stats)
    writer = (
        assembled_stream(messages, as_of, ttl_millis, clock, delay).writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(upsert)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if ttl_millis is None:
        return writer.start()
    with _setting(spark, _PROVIDER, expiry.ROCKSDB):
        return writer.start()
