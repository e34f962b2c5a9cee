"""Benchmark decontamination by winnowing, in DataFrame functions only.

A document and a benchmark item share a window when they share ``WINDOW`` consecutive words. Of every ``WINDOW - GRAM + 1``
consecutive ``GRAM``-word hashes the smallest is kept as fingerprint on both sides. Two texts that share a window choose
the same hash inside it, so no window is lost. Fingerprints are joined, and each hit is extended to the windows around it,
which are compared whole. Items of fewer words than a window are single windows of their own length and are found by
comparing all word runs of that length.

Defined results: a null text has no words; items without words match nothing; repeated items each count; repeated
documents each get the same answer; an empty benchmark leaves every document clean. Only the id and text columns are read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import named, saved

WINDOW = 10
GRAM = 5
SPAN = WINDOW - GRAM + 1
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(low, NO_WORD), lambda w: w != "")


def _run(hashes: Column, start: Column, n: int) -> Column:
    """Hash of ``n`` word hashes from 0-based ``start``."""
    return F.xxhash64(*[F.get(hashes, start + i) for i in range(n)])


def _positions(n: Column) -> Column:
    """0 to n - 1; none for n below 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def runs(hashes: Column, n: int) -> Column:
    return F.transform(_positions(F.size(hashes) - n + 1), lambda i: _run(hashes, i, n))


def _picks(hashes: Column) -> Column:
    """Winnowed fingerprints: position, hash, and the word hashes that windows around it can hold."""
    def pick(grams: Column) -> Column:
        lows = F.transform(_positions(F.size(grams) - SPAN + 1), lambda i: F.least(*[F.get(grams, i + j) for j in range(SPAN)]))

        def chosen(low: Column) -> Column:
            # a hash is kept when it is the smallest of one of the spans that hold it
            at = F.filter(
                F.transform(grams, lambda g, p: F.when(F.array_contains(F.slice(low, F.greatest(p - SPAN + 2, F.lit(1)), F.least(p + 1, F.lit(SPAN))), g), p)),
                lambda p: p.isNotNull(),
            )
            return F.transform(at, lambda p: F.struct(
                p.alias("p"), F.get(grams, p).alias("gram"), F.greatest(p - SPAN + 1, F.lit(0)).alias("first"),
                F.slice(hashes, F.greatest(p - SPAN + 2, F.lit(1)), F.least(p + 1, F.lit(SPAN)) + WINDOW - 1).alias("around"),
            ))
        return named(lows, chosen)
    return named(runs(hashes, GRAM), pick)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows of the items: ``n`` words, their ``window`` hash and the ``item_id`` that holds it."""
    hashed = benchmark.select("item_id", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    long = hashed.where(F.size("h") >= WINDOW).select("item_id", F.lit(WINDOW).alias("n"), F.explode(runs(F.col("h"), WINDOW)).alias("window"))
    short = hashed.where(F.size("h").between(1, WINDOW - 1)).select("item_id", F.size("h").alias("n"), _short_hash(F.col("h")).alias("window"))
    return long.unionByName(short).distinct()


def _short_hash(h: Column) -> Column:
    value = _run(h, F.lit(0), 1)
    for n in range(2, WINDOW):
        value = F.when(F.size(h) == n, _run(h, F.lit(0), n)).otherwise(value)
    return value


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document row: ``doc_id, text_hash, n_words``, the window starts with lengths and the items found."""
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    by_item = saved(item_windows(benchmark), "item-windows")
    windows = by_item.select("n", "window").distinct().withColumn("shared", F.lit(True))
    grams = (
        benchmark.select(F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h")).where(F.size("h") >= WINDOW)
        .select(F.explode(F.transform(_picks(F.col("h")), lambda x: x["gram"])).alias("gram")).distinct().withColumn("found", F.lit(True))
    )
    # every document has one row of its own, at position -1; its key is spread like a hash
    own = F.struct(F.lit(-1).alias("p"), F.xxhash64("text_hash", "doc_id").alias("gram"), F.lit(0).alias("first"), F.array().cast("array<bigint>").alias("around"))
    rows = hashed.select(
        "doc_id", "text_hash", F.size("h").cast("bigint").alias("n_words"), F.explode(F.concat(F.array(own), _picks(F.col("h")))).alias("pick"),
    ).select("doc_id", "text_hash", "n_words", "pick.*")
    met = rows.join(grams, "gram", "left").where("found OR p < 0")
    kept = F.when(F.col("p") < 0, F.array(F.struct(F.lit(-1).alias("start"), F.col("gram").alias("window")))).otherwise(
        F.transform(runs(F.col("around"), WINDOW), lambda w, i: F.struct((F.col("first") + i).alias("start"), w.alias("window"))))
    extended = met.select("doc_id", "text_hash", "n_words", F.lit(WINDOW).alias("n"), F.explode(kept).alias("at")).select("doc_id", "text_hash", "n_words", "n", "at.*")
    found = extended
    for n in _short_lengths(windows):
        found = found.unionByName(
            hashed.select("doc_id", "text_hash", F.size("h").cast("bigint").alias("n_words"), F.lit(n).alias("n"), F.posexplode(runs(F.col("h"), n)).alias("start", "window")))
    hit = F.coalesce("shared", F.lit(False)) & (F.col("start") >= 0)
    joined = saved(found.join(windows, ["n", "window"], "left").where("shared OR start < 0").withColumn("shared", hit), "window-hits")
    # a window held by many items is met once per document, however often it occurs there
    met_items = (
        joined.where("shared").select("doc_id", "text_hash", "n", "window").distinct()
        .join(by_item, ["n", "window"]).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_text"), "item_id").distinct()
        .groupBy("_doc", "_text").agg(F.collect_list("item_id").alias("items"))
    )
    spans = joined.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("shared"), F.struct("start", "n")))).alias("spans"),
        F.sum(F.when(F.col("start") < 0, 1).otherwise(0)).alias("rows"),
    )
    same = spans["doc_id"].eqNullSafe(met_items["_doc"]) & spans["text_hash"].eqNullSafe(met_items["_text"])
    none = F.array().cast(met_items.schema["items"].dataType)
    return spans.join(met_items, same, "left").select("doc_id", "text_hash", "n_words", "spans", F.coalesce("items", none).alias("items"), "rows")


def _short_lengths(windows: DataFrame) -> list[int]:
    """Lengths below a window that items have: nine values at most."""
    return sorted(r[0] for r in windows.where(F.col("n") < WINDOW).select("n").distinct().collect())


def covered(spans: Column) -> Column:
    """Positions inside any of the spans, which are ordered by start."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("total"))

    def add(acc: Column, s: Column) -> Column:
        end = s["start"] + s["n"]
        return F.struct(
            F.greatest(acc["end"], end).alias("end"),
            (acc["total"] + F.greatest(end - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("total"),
        )
    return F.aggregate(spans, start, add, lambda acc: acc["total"])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row: ``doc_id, text_hash, n_words, spans, items, n_hit, contaminated``."""
    found = hits(docs, benchmark).withColumn("n_hit", covered(F.col("spans"))).withColumn("contaminated", F.col("n_hit") > 0)
    # rows that are equal in id and text were answered together
    return found.select("*", F.explode(F.sequence(F.lit(1), F.greatest(F.col("rows"), F.lit(1)))).alias("copy")).drop("copy")


def digest(found: DataFrame) -> DataFrame:
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that share no window with the benchmark."""
    bad = decontaminate(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("_hit_id"), F.col("text_hash").alias("_hit_text")).distinct()
    same = docs["doc_id"].eqNullSafe(bad["_hit_id"]) & (F.xxhash64(docs["text"]) == bad["_hit_text"])
    return docs.join(bad, same, "left_anti")
