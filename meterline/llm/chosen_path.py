"""N-gram Jaccard join by chosen paths: documents whose sets of five-word shingles have a similarity of at least 0.8.

1. Equal sets are one vertex; its copies are counted, not compared.
2. Runs: in each run every set picks its ``PICKS`` smallest shingles under the run's hash. A shared pick puts two sets into
   one bucket. As many runs are made as the target recall needs at the threshold.
3. Buckets above ``LEAF`` sets split again: each set picks further shared tokens by the hash of the path so far. Buckets
   that stay large at ``DEPTH`` are compared in blocks, every pair of blocks once, so nothing is capped.
4. Small buckets are compared by brute force on sketches of the sets. A pivot links all sets that are loosely similar to
   it; sets nearly equal to a pivot need not be pivots, because by the triangle inequality of Jaccard distance what is
   similar to them is loosely similar to the pivot.
5. The links make candidate groups. Inside each group all pairs are verified exactly on the whole sets, in blocks of
   ``CHUNK``; links are counted where they are found and only one edge per set leaves the task.

Defined results: texts of fewer than five words are one shingle; texts without words (null or empty) are compared with
nothing and form classes of their own; rows equal in text are copies of one another; an empty table gives an empty result.
Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from meterline.llm.common import WordHashes, mix, saved
from meterline.llm.graph import components

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999999
PICKS = 2
SKETCH = 64
LEAF = 2000
DEPTH = 2
CHUNK = 64
#: Shared part of a sketch that links loosely, and the part that makes a set as good as the pivot. Of a pair at the threshold,
#: one inside the other, sketches of 64 share fewer than half with a probability of 2e-8.
LOOSE, EQUAL = 0.5, 0.95
LOOSE_SIZE = 0.6
SETS = "doc_id bigint, text_hash bigint, n int, v bigint, keys array<bigint>, sketch array<int>"
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def missed(mine: float, other: float, picks: int = PICKS) -> float:
    """Probability that two sets share no pick, when these parts of their union are in one of them only.

    Picks are the first in a random order of the union, so they meet unless one set has filled its picks with what only
    it holds before a shared one comes.
    """
    def rest(x: int, y: int) -> float:
        return 1.0 if picks in (x, y) else mine * rest(x + 1, y) + other * rest(x, y + 1)
    return rest(0, 0)


def runs_needed(recall: float = RECALL, similarity: float = SIMILARITY, levels: int = DEPTH) -> int:
    """Runs after which a pair at the threshold is missed with a probability of at most ``1 - recall``.

    The worst pair is one where a set contains the other: all that is apart lies on one side. Its bucket may be split at
    every level, and there both sets pick from sketches of equal size, which share ``similarity`` of their entries.
    """
    in_sketch = (1 - similarity) / (2 - similarity)
    met = (1 - missed(1 - similarity, 0.0)) * (1 - missed(in_sketch, in_sketch)) ** levels
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def shingles(text: str | None, cache: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    words = (text or "").split()
    h = cache.of(words)
    if not len(h):
        return h
    if len(h) < WORDS:
        s = np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(h))], dtype=np.uint64)
    else:
        s = np.zeros(len(h) - WORDS + 1, dtype=np.uint64)
        for i in range(WORDS):
            s += h[i: len(h) - WORDS + 1 + i] * _ODD[i]
    return np.unique(mix(s))


def set_rows(docs: DataFrame, runs: int) -> DataFrame:
    seeds = mix(np.arange(1, runs + 1, dtype=np.uint64) * _ODD[0])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            n, v, keys, sketches = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, cache)
                n.append(len(s))
                v.append(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64))
                if len(s) > PICKS:
                    picked = {int(x) for seed in seeds for x in s[np.argpartition(mix(s ^ seed), PICKS)[:PICKS]].view(np.int64)}
                else:
                    picked = set(s.view(np.int64).tolist())
                keys.append(list(picked))
                sketches.append((s[:SKETCH] >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int32()), pa.array(v, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int32()))],
                names=["doc_id", "text_hash", "n", "v", "keys", "sketch"])
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(each, SETS)


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def grouped(batches: Iterator[pa.RecordBatch], key: str, rows) -> Iterator[tuple[int, list]]:
    """Groups of consecutive rows with equal keys; ``rows`` makes a list from a batch."""
    current, members = None, []
    for batch in batches:
        for k, row in zip(batch.column(key).to_pylist(), rows(batch), strict=True):
            if k != current:
                if members:
                    yield current, members
                current, members = k, []
            members.append(row)
    if members:
        yield current, members


class Overlaps:
    """Sizes of the intersections of one set with all sets of a group."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets])
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        values = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.size)
        _, self.token = np.unique(values, return_inverse=True)
        self.owners = owner[np.argsort(self.token, kind="stable")]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(self.token))])

    def of(self, p: int) -> np.ndarray:
        t = self.token[self.at[p]: self.at[p + 1]]
        first, n = self.start[t], self.start[t + 1] - self.start[t]
        where = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.bincount(self.owners[where], minlength=len(self.size))


def unite(roots: np.ndarray, p: int, linked: np.ndarray) -> None:
    """Give ``p``, the linked rows and all that shares a component with them the smallest root among them."""
    met = np.unique(roots[linked])
    met = met[met != roots[p]]
    if len(met):
        met = np.append(met, roots[p])
        roots[np.isin(roots, met)] = met.min()


def bucket_links(v: list[int], n: np.ndarray, sketches: list[np.ndarray]) -> list[tuple[int, int]]:
    """One edge from each linked set of a bucket to the first of its local component."""
    roots, meet, retired = np.arange(len(v)), Overlaps(sketches), np.zeros(len(v), dtype=bool)
    for p in range(len(v)):
        if retired[p]:
            continue
        shared, least = meet.of(p), np.minimum(meet.size, meet.size[p])
        ratio = np.minimum(n, n[p]) / np.maximum(n, n[p])
        linked = (shared >= LOOSE * least) & (ratio >= LOOSE_SIZE)
        unite(roots, p, linked)
        retired |= linked & (shared >= EQUAL * least) & (ratio >= EQUAL)
    return [(v[r], v[i]) for i, r in enumerate(roots.tolist()) if r != i]


def _split(large: DataFrame, sets: DataFrame) -> DataFrame:
    """Next level of paths: ``key, v, used`` of the children of large buckets."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, vs, used = [], [], []
            rows = zip(batch.column("key").to_pylist(), batch.column("v").to_pylist(), batch.column("used").to_pylist(), _lists(batch.column("sketch")), strict=True)
            for key, v, path, sketch in rows:
                left = sketch[~np.isin(sketch, path)].view(np.uint32).astype(np.uint64)
                order = mix(left ^ np.int64(key).view(np.uint64))
                for i in np.argsort(order)[:PICKS]:
                    keys.append(int(order[i].view(np.int64)))
                    vs.append(v)
                    used.append([*path, int(left[i].astype(np.uint32).view(np.int32))])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(vs, pa.int64()), pa.array(used, pa.list_(pa.int32()))], names=["key", "v", "used"])
    return large.join(sets.select("v", "sketch"), "v").select("key", "v", "used", "sketch").mapInArrow(each, "key bigint, v bigint, used array<int>")


def buckets(sets: DataFrame) -> DataFrame:
    """``key, v`` of all small buckets with two sets or more."""
    paths = sets.select(F.explode("keys").alias("key"), "v").withColumn("used", F.array(F.shiftright("key", 32).cast("int")))
    small = None
    for depth in range(DEPTH + 1):
        sizes = paths.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        rows = saved(paths.join(sizes, "key"), f"paths-{depth}")
        leaves = rows.where(F.col("size") <= LEAF).select("key", "v")
        small = leaves if small is None else small.unionByName(leaves)
        large = rows.where(F.col("size") > LEAF)
        if large.isEmpty():
            return small
        if depth < DEPTH:
            paths = _split(large, sets)
    half = F.ceil(F.col("size") * 2 / LEAF).cast("int")
    mine = F.pmod(F.xxhash64("v"), half).cast("int")
    other = large.select("key", "v", mine.alias("i"), F.explode(F.sequence(F.lit(0), half - 1)).alias("j"))
    blocks = other.select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "v")
    return small.unionByName(blocks)


def candidate_edges(sets: DataFrame) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            return zip(batch.column("v").to_pylist(), batch.column("n").to_pylist(), _lists(batch.column("sketch")), strict=True)
        for _, members in grouped(batches, "key", rows):
            edges = bucket_links([m[0] for m in members], np.array([m[1] for m in members]), [m[2] for m in members]) if len(members) > 1 else []
            if edges:
                a, b = zip(*edges, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    rows = buckets(sets).join(sets.select("v", "n", "sketch"), "v").select("key", "v", "n", "sketch")
    return rows.repartition("key").sortWithinPartitions("key", "v").mapInArrow(each, "a bigint, b bigint").distinct()


def verify(members: DataFrame) -> DataFrame:
    """Exact links inside candidate groups: ``v, links, root``; ``members`` has ``v, label, copies, text``."""
    sizes = members.groupBy("label").agg(F.count("*").alias("size"))
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    rows = members.join(sizes, "label").select("v", "label", "copies", "text", F.pmod(F.xxhash64("v"), chunks).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("j"))
    rows = rows.select("v", "copies", "text", "i", (F.col("i") == F.col("j")).alias("inside"), F.xxhash64("label", F.least("i", "j"), F.greatest("i", "j")).alias("key"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()

        def read(batch: pa.RecordBatch) -> Iterator[tuple]:
            return zip(*[batch.column(c).to_pylist() for c in ("v", "copies", "i", "inside")], [shingles(t, cache) for t in batch.column("text").to_pylist()], strict=True)
        for _, group in grouped(batches, "key", read):
            v, copies, side, inside = [m[0] for m in group], np.array([m[1] for m in group]), np.array([m[2] for m in group]), group[0][3]
            meet, roots, links = Overlaps([m[4] for m in group]), np.arange(len(v)), []
            for p in range(len(v)):
                shared = meet.of(p)
                alike = shared >= SIMILARITY * (meet.size + meet.size[p] - shared) - 1e-9
                alike &= side == side[p] if inside else side != side[p]
                alike[p] = False
                links.append(int(copies[alike].sum()))
                unite(roots, p, alike)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(links, pa.int64()), pa.array([v[r] for r in roots.tolist()], pa.int64())], names=["v", "links", "root"])
    return rows.repartition("key").sortWithinPartitions("key", "v").mapInArrow(each, "v bigint, links bigint, root bigint")


def near_duplicates(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """One row per document row: ``doc_id, text_hash, n_shingles, class_id, n_links, keeper``.

    ``class_id`` is the smallest id of the class, ``n_links`` counts the other documents of at least the similarity
    (copies included), ``keeper`` marks the rows with the smallest id and text hash of their class.
    """
    rows = saved(set_rows(docs, runs_needed(recall)), "sets")
    worded = rows.where("n > 0")
    sets = saved(worded.groupBy("v").agg(F.count("*").alias("copies"), F.min("text_hash").alias("text_hash"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")), "vertices")
    groups = components(candidate_edges(sets))
    wanted = saved(groups.join(sets.select("v", "copies", "text_hash"), "v").withColumnRenamed("text_hash", "want"), "candidates")
    texts = docs.select("text", F.xxhash64("text").alias("text_hash"))
    # the wanted sets grow with the corpus, so texts meet them by a shuffle at every size
    members = texts.join(wanted.hint("merge"), F.col("text_hash") == F.col("want")).groupBy("v").agg(F.first("label").alias("label"), F.first("copies").alias("copies"), F.first("text").alias("text"))
    found = saved(verify(members), "links")
    classes = components(found.select(F.col("root").alias("a"), F.col("v").alias("b")))
    links = found.groupBy("v").agg(F.sum("links").alias("links"))
    of_set = sets.select("v", "copies").join(classes, "v", "left").join(links, "v", "left").select("v", F.coalesce("label", "v").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    placed = saved(worded.select("doc_id", "text_hash", "n", "v").join(of_set, "v"), "placed")
    first = placed.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.min(F.struct("doc_id", "text_hash")).alias("first"))
    out = placed.join(first, "label").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "class_id", "n_links", F.struct("doc_id", "text_hash").eqNullSafe(F.col("first")).alias("keeper"))
    alone = rows.where("n = 0").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), F.lit(True).alias("keeper"))
    return out.unionByName(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns unchanged, with one row of each class; texts without words stay."""
    rows = saved(near_duplicates(docs), "near-duplicates")
    gone = rows.where("NOT keeper").select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_text")).distinct()
    kept = docs.join(gone.hint("merge"), docs["doc_id"].eqNullSafe(gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["_text"]), "left_anti")
    twice = rows.where("keeper AND n_shingles > 0").groupBy("doc_id", "text_hash").count().where("count > 1").select(F.col("doc_id").alias("_twice"), F.col("text_hash").alias("_text"))
    twice = saved(twice, "repeated")
    if twice.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(twice["_twice"]) & (F.xxhash64(kept["text"]) == twice["_text"])
    return kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "class_id", "n_links", "n_shingles", "keeper")
