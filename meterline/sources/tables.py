"""Keyed tables on parquet: last write wins, only touched partitions are rewritten."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from meterline.operators.ledger import KEYS, LEDGER, SIGN
from meterline.operators.upsert import latest_per_key, merge_by_key
from meterline.schemas import COMPLETE_TRIP, ZONE_HOURLY_KPIS
from meterline.sources.changelog import KeyedLog
from meterline.sources.store import bytes_under, child_names, path_exists, read_text, release_shuffles, remove_path, rename_path, touch, write_text

#: A delivery of which one row in so many has a key that comes again is reduced to one row per key as a whole.
MOST_REPEATED = 2
#: Up to so many partitions, rows are not moved before they are written: every task writes a file per partition, and tasks are so few
#: that files have this size on average. With more partitions that would leave fewer tasks than a shuffle with parts of 64 MB.
FEW_DAYS, LEAST_FILE = 64, 1 << 20
#: Deliveries that rewrite so many bytes give their shuffle files back at once.
LARGE = 1 << 28


def _write(rows: DataFrame, path: str, *partition: str) -> None:
    """Hashed keys fill most of a row; they are hexadecimal, which zstd halves and snappy leaves as it is."""
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition).parquet(path)


@dataclass(frozen=True)
class KeyedTable:
    """A parquet table with unique ``keys``, partitioned by one column derived from the row.

    ``key_sets_partition`` says that equal keys always fall in the same partition. Then an upsert
    needs no look at the table to know what to rewrite; otherwise an index beside the table, bucketed by
    the hash of the key, tells the partition of every key, and only the buckets of updated keys are read.
    """

    name: str
    path: str
    schema: T.StructType
    keys: Sequence[str]
    partition: str
    partition_of: Callable[[], Column]
    key_sets_partition: bool
    #: Keep what each delivery changed: new rows with sign 1, the rows they replaced with sign -1.
    keep_changes: bool = False

    def read(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).drop(self.partition)

    def read_days(self, spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
        """Rows of the partitions from ``first`` to ``last``; other partitions are not listed or read."""
        day = F.col(self.partition)
        return self._stored(spark).where(day.between(F.lit(first), F.lit(last))).drop(self.partition)

    def read_partitions(self, spark: SparkSession, days: Sequence[dt.date | None]) -> DataFrame:
        """Rows of exactly these partitions."""
        return self._of_days(self._stored(spark), days).drop(self.partition)

    def _of_days(self, stored: DataFrame, days: Sequence[dt.date | None]) -> DataFrame:
        day = F.col(self.partition)
        return stored.where(day.isin([d for d in days if d is not None]) | (day.isNull() if None in days else F.lit(False)))

    def changes(self, spark: SparkSession, batch_id: str) -> DataFrame:
        """What a delivery changed, with ``change_sign``; none for a delivery without rows.

        The new rows are the delivery as it was prepared, which is kept and not copied; the replaced ones are written when they are found.
        """
        schema = T.StructType([*self.schema.fields, T.StructField(SIGN, T.IntegerType())])
        path = self._changes_path(batch_id)
        parts = child_names(spark, path)
        if not {"arrived", "latest"} & {*parts}:
            # changes from before they were kept in parts have their sign in the rows
            return spark.read.schema(schema).parquet(path) if parts else spark.createDataFrame([], schema)
        both = self._update(spark, path).withColumn(SIGN, F.lit(1))
        if "replaced" in parts:
            replaced = spark.read.schema(self._full_schema()).parquet(f"{path}/replaced")
            both = both.unionByName(replaced.withColumn(SIGN, F.lit(-1)))
        return both.select(*schema.names)

    def forget_changes(self, spark: SparkSession, batch_id: str) -> None:
        remove_path(spark, self._changes_path(batch_id))

    def _changes_path(self, batch_id: str) -> str:
        return f"{self.path}/_changes/{batch_id}"

    def _full_schema(self) -> T.StructType:
        return T.StructType(self.schema.fields + [T.StructField(self.partition, T.DateType())])

    def _stored(self, spark: SparkSession) -> DataFrame:
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], self._full_schema())
        return spark.read.schema(self._full_schema()).parquet(self.path)

    def lookup(self, spark: SparkSession, *key: object, day: dt.date | None = None) -> DataFrame:
        """The row of a key. With its ``day`` one partition is read, else the key column filters the row groups."""
        rows = self._stored(spark) if day is None else self._stored(spark).where(F.col(self.partition) == F.lit(day))
        for name, value in zip(self.keys, key, strict=True):
            rows = rows.where(F.col(name) == value)
        return rows.drop(self.partition)

    def stage_path(self, batch_id: str) -> str:
        """Where a delivery is prepared and remembered: below the table, so that it lives and goes with it."""
        return f"{self.path}/_deliveries/{batch_id}"

    def upsert(self, spark: SparkSession, updates: DataFrame, batch_id: str, order_by: Sequence[str] = ()) -> int:
        """Insert or replace rows by key; returns the rows taken. ``batch_id`` names the delivery; repeating it is safe.

        The merged content of every touched partition is written once, below the table, and published by
        renaming its folder. A driver lost in the middle of that may leave a partition removed but not yet
        replaced; the repeated call goes on with the renames that are left instead of computing a new copy
        from the gap. A delivery that was published is only remembered by an empty marker file, and taking
        it again returns 0.
        """
        stage = self.stage_path(batch_id)
        if path_exists(spark, f"{stage}/published"):
            return 0
        changes = self._changes_path(batch_id) if self.keep_changes else None
        if not path_exists(spark, f"{stage}/emptied"):
            self._stage(spark, updates, order_by, stage, changes)
        # a delivery that an earlier version prepared lies below the table
        kept = changes is not None and {"arrived", "latest"} & {*child_names(spark, changes)}
        update = self._update(spark, changes if kept else stage)
        taken = update.count()
        large = bytes_under(spark, f"{stage}/merged") >= LARGE
        self._publish(spark, stage)
        if taken and not self.key_sets_partition:
            self.index.append(spark, update.select(*self.keys, self.partition), batch_id)
        touch(spark, f"{stage}/published")
        for part in ("arrived", "repeated", "winners", "latest", "touched", "old", "merged", "emptied"):
            remove_path(spark, f"{stage}/{part}")
        if large:
            release_shuffles(spark)
        return taken

    @property
    def index(self) -> KeyedLog:
        """The partition of every key."""
        keys = [f for f in self.schema.fields if f.name in self.keys]
        return KeyedLog(f"{self.path}/_index", T.StructType([*keys, T.StructField(self.partition, T.DateType())]), tuple(self.keys))

    def _stage(self, spark: SparkSession, updates: DataFrame, order_by: Sequence[str], stage: str, changes: str | None = None) -> None:
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        order = [c for c in order_by if c not in self.schema.names]
        # written once: it is read for its keys, for the touched partitions, the anti join and the union, and for what it changes
        rows = updates.select(*typed, *order).withColumn(self.partition, self.partition_of())
        at = changes or stage
        for part in ("latest", "winners", "replaced"):
            remove_path(spark, f"{at}/{part}")
        _write(rows, f"{at}/arrived")
        arrived = spark.read.schema(rows.schema).parquet(f"{at}/arrived")
        # most keys come once, and their rows need neither be ordered nor moved: only hashes of keys are counted. Those that come
        # again are stored, so that Catalyst knows how many they are before it decides whether whole rows have to move
        complete = reduce(and_, [F.col(k).isNotNull() for k in self.keys])
        key_hash = F.when(complete, F.xxhash64(*self.keys)).alias("_hash")
        counted = arrived.select(key_hash).where("_hash is not null").groupBy("_hash").agg(F.count("*").alias("n"))
        counted.where("n > 1").write.mode("overwrite").parquet(f"{stage}/repeated")
        repeated = spark.read.schema("_hash bigint, n bigint").parquet(f"{stage}/repeated")
        many = repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * MOST_REPEATED > arrived.count()
        if many:
            # rows move once, and those of one task are combined before
            newest = latest_per_key(arrived.where(complete), self.keys, order_by).unionByName(arrived.where(~complete))
        else:
            again = arrived.select("*", key_hash).join(repeated, "_hash", "left_semi").drop("_hash")
            newest = latest_per_key(again, self.keys, order_by)
        _write(newest.select(*self.schema.names, self.partition), f"{at}/latest" if many else f"{at}/winners")
        if many:
            remove_path(spark, f"{at}/arrived")
        update = self._update(spark, at)
        if update.isEmpty():
            write_text(spark, f"{stage}/emptied", "[]")
            return
        self._touched(spark, update).coalesce(1).write.mode("overwrite").parquet(f"{stage}/touched")
        days = self._days(spark, stage)
        there = set(child_names(spark, self.path))
        stored = [d for d in days if self._folder(d) in there]
        merged, sources = update, [f"{at}/latest" if many else f"{at}/arrived"]
        if stored:
            old = self._of_days(self._stored(spark), stored)
            if changes is None:
                merged = merge_by_key(old, update, self.keys)
                sources += [f"{self.path}/{self._folder(d)}" for d in stored]
            else:
                merged = self._split(spark, old, update, stage, changes).unionByName(update)
                sources.append(f"{stage}/old")
        if len(days) <= FEW_DAYS:
            size = sum(bytes_under(spark, path) for path in sources)
            merged = merged.coalesce(max(1, size // (len(days) * LEAST_FILE)))
        else:
            merged = merged.hint("rebalance", self.partition)
        _write(merged, f"{stage}/merged", self.partition)
        filled = set(child_names(spark, f"{stage}/merged"))
        write_text(spark, f"{stage}/emptied", json.dumps(sorted({self._folder(d) for d in days} - filled)))

    def _split(self, spark: SparkSession, old: DataFrame, update: DataFrame, stage: str, changes: str) -> DataFrame:
        """The rows of ``old`` that stay. One join tells them from those that are replaced, which go to ``changes``."""
        found = update.select(*self.keys, F.lit(True).alias("_found"))
        split = old.join(found, list(self.keys), "left").withColumn("replaced", F.col("_found").isNotNull()).drop("_found")
        _write(split, f"{stage}/old", "replaced")
        if bytes_under(spark, f"{stage}/old") >= LARGE:
            release_shuffles(spark)
        if path_exists(spark, f"{stage}/old/replaced=true"):
            rename_path(spark, f"{stage}/old/replaced=true", f"{changes}/replaced")
        stay, schema = f"{stage}/old/replaced=false", self._full_schema()
        return spark.read.schema(schema).parquet(stay) if path_exists(spark, stay) else spark.createDataFrame([], schema)

    def _update(self, spark: SparkSession, at: str) -> DataFrame:
        """The rows of a delivery, one per key: those that came once and the winners of the others."""
        rows = spark.read.schema(self._full_schema())
        if path_exists(spark, f"{at}/latest/_SUCCESS"):
            return rows.parquet(f"{at}/latest")
        arrived = rows.parquet(f"{at}/arrived")
        return merge_by_key(arrived, rows.parquet(f"{at}/winners"), self.keys)

    def _folder(self, day: dt.date | None) -> str:
        return f"{self.partition}={day or '__HIVE_DEFAULT_PARTITION__'}"

    def _days(self, spark: SparkSession, stage: str) -> list:
        """Touched days; only this list comes to the driver, as literals for partition pruning."""
        return [row[0] for row in spark.read.parquet(f"{stage}/touched").collect()]

    def _touched(self, spark: SparkSession, update: DataFrame) -> DataFrame:
        days = update.select(self.partition)
        if not self.key_sets_partition:
            if not self.index.exists(spark) and any(n.startswith(f"{self.partition}=") for n in child_names(spark, self.path)):
                # a table from before it had an index
                self.index.append(spark, self._stored(spark).select(*self.keys, self.partition), "all")
            days = days.unionByName(self.index.of_keys(spark, update.select(*self.keys)).select(self.partition))
        return days.distinct()

    def _publish(self, spark: SparkSession, stage: str) -> None:
        for folder in child_names(spark, f"{stage}/merged"):
            if folder.startswith(f"{self.partition}="):
                remove_path(spark, f"{self.path}/{folder}")
                rename_path(spark, f"{stage}/merged/{folder}", f"{self.path}/{folder}")
        # a partition whose last row moved elsewhere has nothing to replace it with
        for folder in json.loads(read_text(spark, f"{stage}/emptied")):
            remove_path(spark, f"{self.path}/{folder}")


def staging_table(path: str, keys_hold_time: bool = False, keep_changes: bool = False) -> KeyedTable:
    """Complete trips by ``trip_key``, one partition per pickup day.

    Batch keys are hashes of the pickup time among others, so a batch-only table may say
    ``keys_hold_time`` and keeps no index of its keys. Keys of event streams are given from outside, and a late
    correction can move a trip to another day, which the index finds.
    """
    return KeyedTable("complete_trip", path, COMPLETE_TRIP, ("trip_key",), "pickup_day",
                      lambda: F.to_date("pickup_ts"), key_sets_partition=keys_hold_time, keep_changes=keep_changes)


def mart_table(path: str) -> KeyedTable:
    """Zone-hour KPIs by ``(zone_id, hour_ts)``, one partition per day."""
    return KeyedTable("zone_hourly_kpis", path, ZONE_HOURLY_KPIS, ("zone_id", "hour_ts"), "hour_day",
                      lambda: F.to_date("hour_ts"), key_sets_partition=True)


def kpi_ledger(path: str) -> KeyedTable:
    """Sums per zone, hour and vehicle, from which KPIs are read; one partition per day."""
    return KeyedTable("kpi_ledger", path, LEDGER, KEYS, "hour_day", lambda: F.to_date("hour_ts"), key_sets_partition=True)
