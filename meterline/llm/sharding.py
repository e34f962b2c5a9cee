"""Shards that balance bytes, tokens and rows together: vector bin packing by dot product.

Documents with equal texts form a group. A group is placed whole unless it alone outweighs a shard; then it is dealt into
pieces. Groups below a fixed share of a shard are bundled by the hash of their text, so that the number of things to
place depends on the number of shards and never on the size of the corpus. The greedy placement of these bounded items
runs on the driver; everything that grows with the corpus stays in Spark.

Defined results: a null text counts as no bytes and no tokens; empty texts form one group, null texts another; repeated
rows are separate rows of one group; an empty table gives an empty result. Only ``doc_id`` and ``text`` are read, so
further columns do not matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.llm.common import saved

#: Weight of a document beside its text.
ROW_BYTES = 16
#: A bundle of small groups holds about this part of a shard.
BUNDLES_PER_SHARD = 256
#: A group that outweighs a shard is dealt into about this many pieces per shard.
PIECES_PER_SHARD = 16
#: Cells per shard within which slots are numbered.
CELLS = 64
DIMENSIONS = ("bytes", "tokens", "rows")


def measures(docs: DataFrame) -> DataFrame:
    """Narrow rows: id, size, checksum, tokens and the group of each document."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.regexp_count(text, F.lit(r"\S+")).cast("bigint").alias("tokens"), F.md5(F.col("text").cast("binary")).alias("group"),
        # tells equal rows apart; written with the rest, so it stays as it is
        F.monotonically_increasing_id().alias("at"),
    )


def _sums() -> list[Column]:
    return [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item (rows of shares per dimension).

    Heavy items go first; each goes where the dot product of its vector with what is left of the shard is highest. A
    last pass moves or swaps the lightest items between the fullest and the emptiest shard while that helps.
    """
    left = np.full((shards, items.shape[1]), 1.0 / shards)
    chosen = np.zeros(len(items), dtype=np.int32)
    for i in np.argsort(-items.max(axis=1), kind="stable"):
        chosen[i] = s = int(np.argmax(left @ items[i]))
        left[s] -= items[i]
    return _even_out(items[:, 0], chosen, left[:, 0])


def _even_out(size: np.ndarray, chosen: np.ndarray, left: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Move items from the shard with the least to the shard with the most room left, in the first dimension."""
    for _ in range(rounds):
        low, high = int(np.argmin(left)), int(np.argmax(left))
        gap = left[high] - left[low]
        own = np.flatnonzero(chosen == low)
        own = own[(size[own] > 0) & (size[own] < gap)]
        if gap * len(left) < 1e-4 or not len(own):
            break
        i = own[np.argmin(np.abs(size[own] - gap / 2))]
        chosen[i] = high
        left[low] += size[i]
        left[high] -= size[i]
    return chosen


def vector_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Columns ``doc_id, size, text_crc32, tokens, shard, slot``; slots count from 0 without gaps in each shard."""
    spark = docs.sparkSession
    rows = saved(measures(docs), "shard-measures")
    total = rows.agg(*_sums()).first()
    whole = {d: max(total[d] or 0, 1) for d in DIMENSIONS}

    def share() -> Column:
        return F.greatest(*[F.col(d) / F.lit(float(whole[d])) for d in DIMENSIONS]) * shards

    group = F.coalesce("group", F.lit("-"))
    groups = rows.groupBy(group.alias("g")).agg(*_sums()).withColumn("share", share())
    # at most one group in `shards` per dimension can outweigh a shard: a few rows, whatever the corpus
    heavy = groups.where("share > 1").select("g", F.ceil(F.col("share") * PIECES_PER_SHARD).cast("int").alias("pieces"))
    # and at most shards * BUNDLES_PER_SHARD groups per dimension are items of their own
    small = pmod_hash(F.col("g"), shards * BUNDLES_PER_SHARD).cast("string")
    own = groups.where(F.col("share") * BUNDLES_PER_SHARD > 1).select("g", F.lit(True).alias("own"))
    dealt = (
        rows.withColumn("g", group).join(F.broadcast(heavy), "g", "left").join(F.broadcast(own), "g", "left")
        .withColumn("item", F.when(F.col("own"), F.concat_ws("/", "g", F.when(F.col("pieces").isNotNull(), pmod_hash(F.col("at"), F.col("pieces"))))).otherwise(small))
        .select("doc_id", "size", "text_crc32", "tokens", "at", "item")
    )
    items = dealt.groupBy("item").agg(*_sums()).orderBy("item").collect()
    if not items:
        return rows.select("doc_id", "size", "text_crc32", "tokens", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    chosen = place(np.array([[r[d] / whole[d] for d in DIMENSIONS] for r in items]), shards)
    places = spark.createDataFrame([(r["item"], int(s)) for r, s in zip(items, chosen, strict=True)], "item string, shard int")
    placed = dealt.join(F.broadcast(places), "item").withColumn("cell", pmod_hash(F.col("at"), CELLS))
    return numbered(placed).select("doc_id", "size", "text_crc32", "tokens", "shard", "slot")


def pmod_hash(value: Column, n: Column | int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(n) if isinstance(n, int) else n).cast("int")


def numbered(placed: DataFrame) -> DataFrame:
    """Slots: a cell starts where the cells before it end; only one cell of a shard is ordered in one task."""
    cells = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size", "at")
    return (
        placed.withColumn("k", F.row_number().over(inside))
        # at most CELLS rows per shard
        .join(F.broadcast(starts), ["shard", "cell"])
        .withColumn("slot", (F.col("start") + F.col("k") - 1).cast("bigint"))
    )


def digest(sharded: DataFrame) -> DataFrame:
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens")
