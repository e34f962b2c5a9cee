"""How far each partition of a topic has been taken, kept beside what was made of its messages.

A query's checkpoint knows this, too, but is lost with the query. The ledger belongs to the store: a new query, or one that starts
over, takes no message twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterline.sources.changelog import KeyedLog

COLUMNS = ("topic", "partition", "offset")
_SCHEMA = T.StructType([T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())])


class OffsetLedger:
    def __init__(self, path: str):
        self.log = KeyedLog(path, _SCHEMA, ("topic", "partition"), buckets=16)

    def fresh(self, messages: DataFrame) -> DataFrame:
        """Messages beyond the ledger, each offset once."""
        # one row per partition of a topic
        taken = F.broadcast(self.log.read(messages.sparkSession).withColumnRenamed("offset", "_taken"))
        rows = messages.join(taken, ["topic", "partition"], "left").where("_taken IS NULL OR offset > _taken").drop("_taken")
        return rows.dropDuplicates(list(COLUMNS)).select(*messages.columns)

    def advance(self, messages: DataFrame, batch_id: str) -> None:
        """Remember the last offsets of messages that have been taken."""
        self.log.append(messages.sparkSession, messages.groupBy("topic", "partition").agg(F.max("offset").alias("offset")), batch_id)

    def last(self, spark: SparkSession) -> dict[tuple[str, int], int]:
        return {(r.topic, r.partition): r.offset for r in self.log.read(spark).collect()}
