"""A keyed store to which small changes are appended: bytes written follow the change, not the store.

Every delivery becomes a run of parquet files, sorted by the bucket of the key's hash, so that a reader who wants few keys reads
only the row groups of their buckets. A manifest names the runs that count; writing it publishes a delivery at once. When ``FAN``
runs of a level have come together they are merged into one of the next level, so a row is written again a logarithmic
number of times. There is one writer; readers may come at any time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from meterline.sources.store import child_names, path_exists, read_text, remove_path, touch, write_text

#: Runs of a level that are merged.
FAN = 8
#: Manifests that are kept for readers that still use them.
KEPT = 3


@dataclass(frozen=True)
class KeyedLog:
    """Rows of ``schema`` by ``keys``; the row appended last counts. ``alive`` says which rows may be forgotten in a merge."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 256
    alive: Callable[[], Column] | None = None

    def _full_schema(self) -> T.StructType:
        own = [T.StructField("_bucket", T.IntegerType()), T.StructField("_seq", T.LongType())]
        return T.StructType([*self.schema.fields, *own])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def manifest(self, spark: SparkSession) -> dict:
        names = [n for n in child_names(spark, f"{self.path}/manifest") if n.endswith(".json")]
        return json.loads(read_text(spark, f"{self.path}/manifest/{names[-1]}")) if names else {"seq": 0, "runs": [], "retired": []}

    def exists(self, spark: SparkSession) -> bool:
        return bool(self.manifest(spark)["runs"])

    def _publish(self, spark: SparkSession, manifest: dict) -> None:
        write_text(spark, f"{self.path}/manifest/{manifest['seq']:012d}.json", json.dumps(manifest))
        for name in [n for n in child_names(spark, f"{self.path}/manifest") if n.endswith(".json")][:-KEPT]:
            remove_path(spark, f"{self.path}/manifest/{name}")

    def append(self, spark: SparkSession, rows: DataFrame, batch_id: str) -> int:
        """Append rows, unique by key; returns their number. Repeating a delivery changes nothing and returns 0."""
        now = self.manifest(spark)
        marker = f"{self.path}/deliveries/{batch_id}"
        if path_exists(spark, marker) or any(r["name"] == batch_id for r in now["runs"]):
            touch(spark, marker)
            return 0
        seq = now["seq"] + 1
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        run = f"{self.path}/runs/{batch_id}"
        self._write(typed.withColumns({"_bucket": self.bucket(), "_seq": F.lit(seq).cast("bigint")}), run)
        taken = spark.read.schema(self._full_schema()).parquet(run).count()
        self._publish(spark, {**now, "seq": seq, "runs": [*now["runs"], {"name": batch_id, "level": 0}]})
        touch(spark, marker)
        self._merge(spark)
        return taken

    def _write(self, rows: DataFrame, path: str) -> None:
        # few files per run whatever the number of buckets; row groups know the buckets they hold
        rows.repartitionByRange("_bucket").sortWithinPartitions("_bucket", *self.keys).write.mode("overwrite").parquet(path)

    def _merge(self, spark: SparkSession) -> None:
        while True:
            now = self.manifest(spark)
            level = next((n for n in sorted({r["level"] for r in now["runs"]}) if sum(r["level"] == n for r in now["runs"]) >= FAN), None)
            if level is None:
                return
            parts = [r["name"] for r in now["runs"] if r["level"] == level]
            rows = self._latest(self._runs(spark, parts))
            # what is dead in the newest version is as dead in older ones
            rows = rows if self.alive is None else rows.where(self.alive())
            name = f"merged-{uuid.uuid4().hex}"
            self._write(rows, f"{self.path}/runs/{name}")
            rest = [r for r in now["runs"] if r["level"] != level]
            self._publish(spark, {"seq": now["seq"] + 1, "runs": [{"name": name, "level": level + 1}, *rest], "retired": parts})
            # runs that the manifest before this one still named go only now
            for old in now["retired"]:
                remove_path(spark, f"{self.path}/runs/{old}")

    def _runs(self, spark: SparkSession, names: Sequence[str]) -> DataFrame:
        if not names:
            return spark.createDataFrame([], self._full_schema())
        return spark.read.schema(self._full_schema()).parquet(*[f"{self.path}/runs/{n}" for n in names])

    def _latest(self, rows: DataFrame) -> DataFrame:
        """The last version of every key: a hash aggregate on the narrow columns, and a join for the rest of the row."""
        last = rows.groupBy(*self.keys, "_bucket").agg(F.max("_seq").alias("_seq"))
        return rows.join(last, [*self.keys, "_bucket", "_seq"], "left_semi")

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None, wanted: DataFrame | None = None) -> DataFrame:
        """Rows as they stand; with ``buckets``, only the row groups of those are read, and with ``wanted`` only its keys kept."""
        names = [r["name"] for r in self.manifest(spark)["runs"]]
        rows = self._runs(spark, names)
        if buckets is not None:
            rows = rows.where(F.col("_bucket").isin(list(buckets)))
        if wanted is not None:
            rows = rows.join(wanted, list(self.keys), "left_semi")
        rows = self._latest(rows) if len(names) > 1 else rows
        return (rows if self.alive is None else rows.where(self.alive())).select(*self.schema.names)

    def of_keys(self, spark: SparkSession, wanted: DataFrame) -> DataFrame:
        """The rows of the keys in ``wanted``; other buckets are not read."""
        # at most as many numbers as there are buckets
        touched = [r[0] for r in wanted.select(self.bucket().alias("b")).distinct().collect()]
        return self.read(spark, touched, wanted)
