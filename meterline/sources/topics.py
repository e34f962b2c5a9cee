"""Event topics: Kafka source and sink, and the file forms used where no broker exists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

#: What a broker takes as one message by default.
MOST_BYTES = 1_048_576
EVENT_TOPIC = "trip-events"


def read_topic_stream(spark: SparkSession, servers: str, topic: str = EVENT_TOPIC,
                      max_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Streaming messages from the earliest offset; progress lives in the query's checkpoint.

    A micro-batch takes all that waits unless ``max_per_trigger`` says less.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return envelope(reader.options(**options).load())


def read_topic_batch(spark: SparkSession, servers: str, topic: str = EVENT_TOPIC) -> DataFrame:
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return envelope(reader.option("startingOffsets", "earliest").load())


def envelope(messages: DataFrame) -> DataFrame:
    """Message envelope with text key and value."""
    return messages.select(
        "topic", "partition", "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )


def to_messages(events: DataFrame, key: str = "trip_key") -> DataFrame:
    """Key and JSON value per event; keying by trip keeps the events of a trip in order."""
    return events.select(F.col(key).alias("key"), F.to_json(F.struct(*events.columns)).alias("value"))


@dataclass
class SinkCounts:
    """Messages handed to a sink and those kept back, by reason."""

    sent: int = 0
    rejected: dict[str, int] = field(default_factory=dict)

    @property
    def failed(self) -> int:
        return sum(self.rejected.values())

    def add(self, metrics: dict) -> None:
        self.sent += metrics["sent"] or 0
        for reason in REJECTED:
            if metrics[reason]:
                self.rejected[reason] = self.rejected.get(reason, 0) + metrics[reason]


def sink_reason(most_bytes: int = MOST_BYTES) -> Column:
    """Why a message is not sent; null for one that is."""
    size = F.octet_length("value") + F.octet_length("key")
    return F.when(F.col("value").isNull(), "no_value").when(F.col("key").isNull(), "no_key").when(size > most_bytes, "too_large")


REJECTED = ("no_value", "no_key", "too_large")


def _counted(messages: DataFrame, seen: Observation, most_bytes: int) -> DataFrame:
    """Messages that are sent; all are counted on their way, in the tasks that send them."""
    reason = F.col("_reason")
    judged = messages.withColumn("_reason", sink_reason(most_bytes))
    measured = judged.observe(seen, F.count_if(reason.isNull()).alias("sent"), *[F.count_if(F.coalesce(reason == r, F.lit(False))).alias(r) for r in REJECTED])
    return measured.where(reason.isNull()).drop("_reason")


def send(messages: DataFrame, write: Callable[[DataFrame], None], most_bytes: int = MOST_BYTES) -> SinkCounts:
    """Write a batch of messages and return what was sent and what was kept back."""
    seen, counts = Observation(), SinkCounts()
    write(_counted(messages, seen, most_bytes))
    counts.add(seen.get)
    return counts


def start_send(messages: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], counts: SinkCounts, most_bytes: int = MOST_BYTES, **trigger: object) -> StreamingQuery:
    """Write a stream of messages, micro-batch by micro-batch; ``counts`` is added to as they end.

    ``write`` gets the messages to send and the number of the micro-batch, by which a repeated one can be told.
    """
    def each(batch: DataFrame, epoch: int) -> None:
        done = send(batch, lambda sent: write(sent, epoch), most_bytes)
        counts.add({"sent": done.sent, **{r: done.rejected.get(r, 0) for r in REJECTED}})

    return messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each).trigger(**(trigger or {"availableNow": True})).start()


KAFKA_SINK = {"kafka.acks": "all", "kafka.retries": "3", "kafka.linger.ms": "5"}


def write_topic(messages: DataFrame, servers: str, topic: str = EVENT_TOPIC) -> SinkCounts:
    def write(sent: DataFrame) -> None:
        sent.write.format("kafka").options(**KAFKA_SINK).option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return send(messages, write)


def read_message_files(spark: SparkSession, path: str, files_per_trigger: int | None = None, offsets: bool = False) -> DataFrame:
    """Streaming messages from parquet files with ``key`` and ``value``, and with ``offsets`` also topic, partition and offset."""
    reader = spark.readStream.schema("key string, value string" + (", topic string, partition int, offset bigint" if offsets else ""))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
