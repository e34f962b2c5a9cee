"""Presence features of texts for the classifiers: words without their punctuation, and the shape of the whole text.

Features are 64-bit hashes, so no vocabulary is built. A batch of texts is taken apart at once: every distinct word of the batch is
trimmed and hashed one time, however often it stands in it, and what is counted per text is counted on word numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from meterline.llm.common import saved

PUNCTUATION = "#*$%&|<>!?.,;:()[]{}\"'`-_/\\+=~^@"
SYMBOLS = "#*$%&|<>"
#: Upper bounds of the classes into which a share of a text is put.
SHARES = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75])
#: Bytes of texts that are taken apart at a time; a longer text comes alone.
SLICE_BYTES = 1 << 22


def feature(name: str) -> int:
    """Signed 64 bits, as Spark keeps them."""
    return xxhash.xxh3_64_intdigest(name) - (1 << 63)


def _shape_feature(kind: str, level: int, size: int) -> int:
    return feature(f"{kind}:{level}/{size}" if size >= 0 else f"{kind}:{level}")


class Found(NamedTuple):
    """The number of words of each text, and its features as (text, feature) pairs, text by text."""
    words: np.ndarray
    owner: np.ndarray
    ids: np.ndarray


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Stretches of a column of texts of bounded size, with the place of the first; null is empty."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right")))
        yield at, texts.slice(at, end - at)
        at = end


def _shapes(texts: pa.Array, owner: np.ndarray, codes: np.ndarray, capital: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Classes of symbol, capital, exclamation, variety, top, stutter shares, and of length; one row of features per text."""
    n = len(texts)
    words = np.bincount(owner, minlength=n)
    of = np.maximum(words, 1)
    # a text's number of words may take any value; its length in bits is its class
    size = np.array([int(w).bit_length() for w in words], dtype=np.int64)

    def level(share: np.ndarray) -> np.ndarray:
        return np.searchsorted(SHARES, share, side="left")
    symbols = sum(pc.count_substring(texts, c).to_numpy(zero_copy_only=False) for c in SYMBOLS)
    distinct, top = np.bincount(pairs, minlength=n), np.zeros(n, dtype=np.int64)
    np.maximum.at(top, pairs, times)
    again = owner[1:][(codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])]
    none = np.full(n, -1)
    kinds = (
        ("symbols", level(symbols / of), none), ("capitals", level(np.bincount(owner, weights=capital[codes], minlength=n) / of), none),
        ("calls", level(pc.count_substring(texts, "!").to_numpy(zero_copy_only=False) / of), none), ("variety", level(distinct / of), size),
        ("top", level(top / of), size), ("size", size, none), ("stutter", level(np.bincount(again, minlength=n) / of), none),
    )
    return np.array([[_shape_feature(kind, int(v), int(z)) for v, z in zip(values, sizes, strict=True)] for kind, values, sizes in kinds], dtype=np.int64).T.reshape(n, len(kinds))


def features(texts: pa.Array) -> Found:
    """Features of whole texts, each at most once for each of its spellings in a text."""
    split = pc.utf8_split_whitespace(texts)
    flat = split.flatten()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    there = pc.greater(pc.binary_length(flat), 0)
    encoded = flat.filter(there).dictionary_encode()
    owner, codes, words = owner[there.to_numpy(zero_copy_only=False)], encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary
    plain = pc.utf8_lower(pc.utf8_trim(words, characters=PUNCTUATION)).to_pylist()
    ids = np.fromiter((feature("w:" + w) for w in plain), np.int64, len(plain))
    capital = pc.and_(pc.utf8_is_upper(words), pc.greater(pc.utf8_length(words), 1)).to_numpy(zero_copy_only=False).astype(float)
    known = max(len(plain), 1)
    pair, times = np.unique(owner * known + codes, return_counts=True)
    pairs, kinds = pair // known, pair % known
    shapes = _shapes(texts, owner, codes, capital, pairs, times)
    whose, found = np.concatenate([pairs, np.repeat(np.arange(len(texts)), shapes.shape[1])]), np.concatenate([ids[kinds], shapes.ravel()])
    order = np.argsort(whose, kind="stable")
    return Found(np.bincount(owner, minlength=len(texts)), whose[order], found[order])


def scores(texts: pa.Array, place: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words, and the sums of the weights of the distinct rows that ``place`` gives the features' buckets."""
    words, out = np.zeros(len(texts), dtype=np.int64), np.zeros((len(texts), weights.shape[1]))
    for at, part in slices(texts):
        found = features(part)
        words[at: at + len(part)] = found.words
        rows = place[found.ids & (WIDTH - 1)]
        own = rows >= 0
        key = np.unique(found.owner[own] * len(weights) + rows[own])
        owner, starts = np.unique(key // len(weights), return_index=True)
        if len(key):
            out[at + owner] = np.add.reduceat(weights[key % len(weights)], starts)
    return words, out


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``doc_id, y, text`` of about ``most`` labelled documents, picked by the hash of their id; ``labels`` has ``doc_id, y``."""
    one = labels.where("doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id").agg(F.min("y").alias("y"))
    share = min(1.0, most / max(one.count(), 1))
    # the sample is bounded by its parameter, so it may be broadcast
    picked = one.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)).withColumnRenamed("doc_id", "_id")
    return docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("doc_id", "y", "text")


def sample_features(sample: DataFrame) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for at, part in slices(texts):
                found = features(part)
                offsets = pa.array(np.searchsorted(found.owner, np.arange(len(part) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)), batch.column("y").slice(at, len(part)), pa.ListArray.from_arrays(offsets, pa.array(found.ids))],
                    names=["doc_id", "y", "found"])
    return saved(sample.mapInArrow(each, f"doc_id bigint, y {sample.schema['y'].dataType.simpleString()}, found array<bigint>"), "features")


#: Buckets of the hashing trick; a power of two.
WIDTH = 1 << 18
#: Entries of a sparse sample that are multiplied at a time.
BLOCK_ENTRIES = 1 << 19


def bucket(f: int) -> int:
    return f & (WIDTH - 1)


def hashed_sample(rows: DataFrame) -> tuple[list, pa.ListArray]:
    """Labels of the bounded sample, and the distinct buckets of all its features."""
    buckets = F.array_distinct(F.transform("found", lambda f: f.bitwiseAND(F.lit(WIDTH - 1)).cast("int")))
    got = rows.select("doc_id", "y", buckets.alias("found")).orderBy("doc_id").toArrow()
    return got.column("y").to_pylist(), got.column("found").combine_chunks()


class Hashed:
    """The sample as a sparse 0/1 matrix over the buckets that say something: in ``least`` documents, and in some class with a
    share that differs from the overall one by ``z`` standard errors. There is no other limit on their number. ``says`` has
    the classes of each, so that the many words of one class do not learn the few documents of another by heart."""

    def __init__(self, found: pa.ListArray, truth: np.ndarray, least: int, z: float):
        values, sizes = found.flatten().to_numpy(zero_copy_only=False), np.diff(found.offsets.to_numpy())
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        n, clear, y = np.bincount(values, minlength=WIDTH), np.zeros((WIDTH, truth.shape[1]), dtype=bool), truth.argmax(axis=1)
        for c, share in enumerate(truth.mean(axis=0, dtype=float).tolist()):
            mine = np.bincount(values[y[owner] == c], minlength=WIDTH)
            clear[:, c] = np.abs(mine - n * share) >= z * np.sqrt(n * max(share * (1 - share), 1e-9))
        self.selected = np.flatnonzero((n >= least) & clear.any(axis=1))
        self.says = clear[self.selected]
        place = np.full(WIDTH, -1, dtype=np.int32)
        place[self.selected] = np.arange(len(self.selected))
        kept = place[values] >= 0
        values, owner = place[values[kept]], owner[kept]
        self.rows, self.blocks = len(sizes), []
        for at in range(0, len(values), BLOCK_ENTRIES):
            v, o = values[at: at + BLOCK_ENTRIES], owner[at: at + BLOCK_ENTRIES]
            order = np.argsort(v, kind="stable")
            self.blocks.append((v, *np.unique(o, return_index=True), o[order], *np.unique(v[order], return_index=True)))

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros((self.rows, w.shape[1]), dtype=w.dtype)
        for v, rows, starts, *_ in self.blocks:
            out[rows] += np.add.reduceat(w[v], starts)
        return out

    def transposed_dot(self, off: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.selected), off.shape[1]), dtype=off.dtype)
        for *_, o, columns, starts in self.blocks:
            out[columns] += np.add.reduceat(off[o], starts)
        return out


def minimise(value_and_gradient: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, tolerance: float = 1e-5, memory: int = 10) -> np.ndarray:
    """The minimum of a smooth convex function by limited-memory BFGS, until no entry of the gradient exceeds ``tolerance``.

    It also ends where rounding lets no step lower the value any more.
    """
    w, (value, g) = start.copy(), value_and_gradient(start)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    while np.abs(g).max(initial=0.0) > tolerance:
        d = g.copy()
        weights = []
        for s, y in reversed(steps):
            a = (s.ravel() @ d.ravel()) / (s.ravel() @ y.ravel())
            weights.append(a)
            d -= a * y
        d *= (steps[-1][0].ravel() @ steps[-1][1].ravel()) / (steps[-1][1].ravel() @ steps[-1][1].ravel()) if steps else 1.0
        for (s, y), a in zip(steps, reversed(weights), strict=True):
            d += s * (a - (y.ravel() @ d.ravel()) / (s.ravel() @ y.ravel()))
        slope, part = d.ravel() @ g.ravel(), 1.0
        while True:
            ahead = w - part * d
            new_value, new_g = value_and_gradient(ahead)
            if new_value <= value - 1e-4 * part * slope:
                break
            part /= 2
            if part < 1e-10:
                if not steps:
                    return w
                # forget the curvature and go downhill
                steps, ahead, new_value, new_g = [], w, value, g
                break
        s, y = ahead - w, new_g - g
        if s.ravel() @ y.ravel() > 1e-12 * (y.ravel() @ y.ravel()):
            steps = [*steps, (s, y)][-memory:]
        w, value, g = ahead, new_value, new_g
    return w
