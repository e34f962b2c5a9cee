"""Phrase collocations by the stripes pattern.

A stripe is a prefix of one or two words with an associative counter of the words that follow it; the counter's entry for
*none* holds the occurrences that nothing countable follows. Tasks build stripes over a bounded number of words, the shuffle
brings the parts of a stripe together, and merging adds them element by element. One merged structure then gives all that
a collocation needs: the entries are the counts of longer phrases (extensions), the sum over all entries is the count of the
prefix itself, and the largest entry says whether an extension swallows the prefix.

Stripes of two-word prefixes are counted only where both pairs inside the three words can be frequent. A bit filter of fixed
size says so; it holds every frequent pair, so it never loses one, and what it lets through by mistake is only counted in vain.
A stripe is dealt in ``SLICES`` parts by its next words, so that the stripe of a very common word fills no task, and the parts are
merged by Spark's aggregate, which spills.

Defined results: null text has no words; null language is ``und``; equal rows count each; a language without words has no
rows. Columns other than ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.llm.common import mix, saved

LEAST_COUNT = 10
#: A phrase is swallowed by a longer one that has this many per cent of its occurrences.
SWALLOWED = 50
TOP = 2000
NO_LANGUAGE = "und"
#: Parts into which a stripe is dealt by the hash of the next word.
SLICES = 64
#: Words of which a task builds stripes before it hands them on, and words that are taken at a time.
FLUSH, CHUNK = 7 << 18, 1 << 17
#: Parts in which the best phrases of a language are looked for first.
RANK_PARTS = 64
#: Bits of the filter of frequent pairs: 16 MB, whatever the corpus.
FILTER_BITS = 1 << 27
#: Bytes of a long text that are split at a time, where a piece ends.
BLOCK_BYTES = 1 << 22

ID_BITS = 21
END = 0
ENDS = b".,;:!?\n\x0b\x0c\r"
#: ASCII capitals to small letters, ends of pieces to line feeds, tabs to spaces.
SMALL = bytes(10 if b in ENDS else 32 if b == 9 else b for b in bytes(range(256)).lower())
#: Next words are joined by spaces, of which words have none; the entry for none is an empty word.
STRIPE = "lang string, prefix string, slice int, next string, n array<int>"


class Ids(dict):
    """Words of a flush and their numbers; the end of a piece is ``END``."""

    def __init__(self) -> None:
        super().__init__({b"\n": END})

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self), np.uint64, len(self))


def blocks(text: str) -> Iterator[bytes]:
    """A whole text in small letters, cut at ends of pieces into blocks."""
    data, at = text.encode().translate(SMALL), 0
    while at < len(data):
        end = data.find(b"\n", at + BLOCK_BYTES)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end + 1


def chunks(text: str) -> Iterator[tuple[list[bytes], int]]:
    """Words of a text and ends of pieces, and how many of them may start a phrase here.

    A piece of more than ``CHUNK`` words is cut, and the two words after the cut come along to end its phrases.
    """
    for data in blocks(text):
        tokens = (data.replace(b"\n", b" \n ") + b" \n").split(b" ")
        for at in range(0, len(tokens), CHUNK):
            own = list(filter(None, tokens[at: at + CHUNK]))
            # double spaces leave empty words, which are none of the two words after the cut
            ahead = islice(filter(None, islice(tokens, at + CHUNK, None)), 2)
            yield [*own, *ahead, b"\n"], len(own)


def pair_places(lang: str, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Where pairs of word hashes are in the filter."""
    seed = np.uint64(xxhash.xxh3_64_intdigest("lang:" + lang))
    return (mix(left * np.uint64(0x9E3779B97F4A7C15) + mix(right ^ seed)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _batch(lang: str, words: pa.Array, slices: np.ndarray, prefix: tuple[np.ndarray, ...], following: np.ndarray) -> pa.RecordBatch:
    """The stripes of one flush: distinct (prefix, next) with counts, put together by prefix and slice."""
    code = prefix[0]
    for more in (*prefix[1:], following):
        code = code << ID_BITS | more
    code, n = np.unique(code, return_counts=True)
    low = (1 << ID_BITS) - 1
    following, head = code & low, code >> ID_BITS
    key = head * SLICES + slices[following]
    order = np.argsort(key, kind="stable")
    key, following, n = key[order], following[order], n[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    offsets = pa.array(np.append(starts, len(key)), pa.int32())
    head, cut = key[starts] // SLICES, key[starts] % SLICES
    names = words.take(pa.array(head & low))
    if len(prefix) == 2:
        names = pc.binary_join_element_wise(words.take(pa.array(head >> ID_BITS)), names, pa.scalar(" ", pa.string()))
    nexts = pa.ListArray.from_arrays(offsets, words.take(pa.array(following)))
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * len(starts), pa.string()), names, pa.array(cut, pa.int32()), pc.binary_join(nexts, " "),
        pa.ListArray.from_arrays(offsets, pa.array(n, pa.int32()))], names=["lang", "prefix", "slice", "next", "n"])


def stripes(docs: DataFrame, prefix_words: int, frequent=None) -> DataFrame:
    """Stripes of all texts as the tasks build them; ``frequent`` broadcasts the filter that two-word prefixes need."""
    def flush(ids: Ids, held: dict) -> Iterator[pa.RecordBatch]:
        # the end of a piece and whatever cannot be frequent is the entry for none
        words, hashes = pa.array([b"", *islice(ids, 1, None)], pa.binary()).cast(pa.string()), ids.hashes()
        slices = (hashes % np.uint64(SLICES)).astype(np.int64)
        for lang, parts in held.items():
            w = np.concatenate([a for a, _ in parts] + [np.array([END, END])])
            own = np.zeros(len(w), dtype=bool)
            at = 0
            for a, owned in parts:
                own[at: at + owned] = True
                at += len(a)
            own &= w != END
            if prefix_words == 1:
                i = np.flatnonzero(own)
                yield _batch(lang, words, slices, (w[i],), w[i + 1])
                continue
            whole = (w[:-1] != END) & (w[1:] != END)
            h = hashes[w]
            may = whole & bit_set(frequent.value, pair_places(lang, h[:-1], h[1:]))
            i = np.flatnonzero(own[:-1] & may)
            i = i[i < len(w) - 2]
            yield _batch(lang, words, slices, (w[i], w[i + 1]), np.where(may[i + 1], w[i + 2], END))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, size = Ids(), defaultdict(list), 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for words, owned in chunks(text):
                    held[lang].append((np.fromiter(map(ids.__getitem__, words), np.int64, len(words)), owned))
                    size += len(words)
                    if size >= FLUSH:
                        yield from flush(ids, held)
                        ids, held, size = Ids(), defaultdict(list), 0
        yield from flush(ids, held)
    rows = docs.where("text IS NOT NULL").select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text")
    return rows.mapInArrow(each, STRIPE)


def merged(parts: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``lang, prefix, slice, total, extensions``: equal stripes added up element by element.

    ``total`` counts every entry; ``extensions`` keeps those of at least ``least``. One shuffle, by prefix and slice.
    """
    key = ["lang", "prefix", "slice"]
    dealt = parts.repartition(*key).select(*key, F.inline(F.arrays_zip(F.split("next", " ").alias("next"), "n")))
    summed = dealt.groupBy(*key, "next").agg(F.sum("n").alias("a"))
    kept = F.when((F.col("next") != "") & (F.col("a") >= least), F.struct("next", "a"))
    return summed.groupBy(*key).agg(F.sum("a").alias("total"), F.collect_list(kept).alias("extensions"))


def totals(stripe: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, f`` of prefixes with at least ``least`` occurrences."""
    return stripe.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.sum("total").alias("f")).where(F.col("f") >= least)


def extensions(stripe: DataFrame) -> DataFrame:
    """``lang, prefix, next, a`` of frequent extensions."""
    return stripe.select("lang", "prefix", F.inline("extensions"))


def bit_set(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def pair_filter(pairs: DataFrame) -> np.ndarray:
    """The filter of frequent pairs: tasks place them, an aggregate sets the bits, at most 16 MB come back."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, rows in pa.Table.from_batches([batch]).to_pandas().groupby("lang"):
                left, right = (np.fromiter((xxhash.xxh3_64_intdigest(w) for w in rows[c]), np.uint64, len(rows)) for c in ("prefix", "next"))
                yield pa.RecordBatch.from_arrays([pa.array(pair_places(lang, left, right))], names=["place"])
    # bitmap places count from 1
    place = F.col("place") + 1
    found = pairs.mapInArrow(each, "place bigint").groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for bucket, part in found.collect():
        at = (bucket - 1) * len(part)
        bits[at: at + len(part)] = np.frombuffer(part, dtype=np.uint8)
    return bits


def _score(left: str, right: str) -> Column:
    """Exact: whole decimals, and their whole quotient."""
    def number(c: str) -> str:
        return f"cast({c} as decimal(15, 0))"
    return F.expr(f"({number('a')} * {number('a')} * cast(1000000 as decimal(7, 0))) div ({number(left)} * {number(right)})")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of two and three words of every language."""
    one = saved(merged(stripes(docs, 1), least), "stripes-1")
    pairs = extensions(one)
    frequent = docs.sparkSession.sparkContext.broadcast(pair_filter(pairs))
    two = saved(merged(stripes(docs, 2, frequent), least), "stripes-2")
    frequent.unpersist()

    words, starts = totals(one, least), totals(two, least)
    triples = extensions(two)
    # what a longer candidate starts with is a stripe; what it ends with is found under its second word
    tail = F.concat_ws(" ", F.substring_index("prefix", " ", -1), "next")
    longest = (
        triples.select("lang", F.col("prefix").alias("phrase"), "a").unionByName(triples.select("lang", tail.alias("phrase"), "a"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    )
    phrase = F.concat_ws(" ", "prefix", "next").alias("phrase")
    two_words = pairs.select("lang", phrase, "a", F.col("prefix").alias("left1"), F.col("next").alias("right1"))
    two_words = two_words.join(longest, ["lang", "phrase"], "left").where(F.col("longest").isNull() | (100 * F.col("longest") < SWALLOWED * F.col("a"))).drop("longest")
    two_words = _with(_with(two_words, words, "left1", "l1"), words, "right1", "r1")
    three_words = triples.select(
        "lang", phrase, "a", F.substring_index("prefix", " ", 1).alias("left1"), tail.alias("right1"), F.col("prefix").alias("left2"), F.col("next").alias("right2"))
    for frame, at, name in ((words, "left1", "l1"), (starts, "right1", "r1"), (starts, "left2", "l2"), (words, "right2", "r2")):
        three_words = _with(three_words, frame, at, name)

    scored = two_words.select("lang", "phrase", "a", F.col("l1").alias("l"), F.col("r1").alias("r"), _score("l1", "r1").alias("score"))
    score1, score2 = F.col("score1"), F.col("score2")
    cut = three_words.withColumns({"score1": _score("l1", "r1"), "score2": _score("l2", "r2")})
    scored = scored.unionByName(cut.select("lang", "phrase", "a", *[
        F.when(score1 <= score2, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(c) for c in ("l", "r", "score")]))
    order = F.desc("score"), F.desc("a"), "phrase"
    # the best of every part hold the best of all, and their number does not grow
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    sizes = one.groupBy("lang").agg(F.sum("total").alias("n"))
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _with(rows: DataFrame, counts: DataFrame, at: str, name: str) -> DataFrame:
    """``rows`` with the count of the phrase in column ``at``."""
    return rows.join(counts.select("lang", F.col("phrase").alias(at), F.col("f").alias(name)), ["lang", at])
