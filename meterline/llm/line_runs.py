"""Deletion of repeated line runs by a suffix array over line ids, in DataFrame functions only.

All documents form one long sequence of lines. Prefix doubling sorts its suffixes into classes: level 0 by the line, level
k+1 by the pair of level-k classes at a position and 2^k lines on. A class is named by its first position, and a suffix
that is alone in its class is done and drops out. Equal names at level k are the intervals of the suffix array whose
longest common prefix is at least 2^k lines; two overlapping level-k classes give the interval of any length up to
2^(k+1). The order inside an interval plays no part, so suffixes are named, not numbered.

A run qualifies when its lines hold ``MIN_WORDS`` words. For every position the shortest qualifying run that begins there,
and the shortest that ends there, have their length from their content alone. Every line of every repeated qualifying run
lies in one of these that is repeated too, so looking up their intervals finds all maximal runs. The first copy of an
interval (in table order) stays and the lines of later copies are deleted, also when copies overlap.

Defined results: a null text stays null; a line without words counts as one word, so runs of such lines end after
``MIN_WORDS`` lines; rows equal in id and text are one document for the result and are treated like its first row; an
empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import named, saved

MIN_WORDS = 50
#: Bits of a position that number the line in its document and the row in its input split.
LINE_BITS = 21
ROW_BITS = 21


def positions() -> Column:
    """First position of a row: split, row in split, then room for its lines."""
    row = F.monotonically_increasing_id()
    part, inside = F.shiftright(row, 33), row.bitwiseAND(F.lit((1 << 33) - 1))
    fits = (part < (1 << 62 - LINE_BITS - ROW_BITS)) & (inside < 1 << ROW_BITS)
    return F.when(fits, F.shiftleft(part, LINE_BITS + ROW_BITS) + F.shiftleft(inside, LINE_BITS)).otherwise(F.raise_error(F.lit("more rows in a split than positions can number")))


def _shortest(weights: Column, i: Column) -> Column:
    """Lines from 0-based ``i`` on until ``MIN_WORDS`` words; 0 when there are not so many."""
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"))

    def add(acc: Column, w: Column) -> Column:
        more = acc["words"] < MIN_WORDS
        return F.struct((acc["words"] + F.when(more, w).otherwise(0)).alias("words"), (acc["lines"] + F.when(more, 1).otherwise(0)).alias("lines"))
    walk = F.aggregate(F.slice(weights, i + 1, F.lit(MIN_WORDS)), start, add, lambda a: F.when(a["words"] >= MIN_WORDS, a["lines"]).otherwise(0))
    return F.when(F.get(weights, i) >= MIN_WORDS, 1).otherwise(walk)


def line_rows(docs: DataFrame) -> DataFrame:
    """``pos, doc, doc_id, text_hash, h1, h2, ahead, back``: each line with the shortest qualifying runs around it."""
    lines = F.split("text", "\n")
    weights = F.transform(lines, lambda x: F.greatest(F.regexp_count(x, F.lit(r"\S+")), F.lit(1)))

    def rows(w: Column) -> Column:
        return named(F.reverse(w), lambda r: F.transform(lines, lambda x, i: F.struct(
            F.xxhash64(x).alias("h1"), F.crc32(x.cast("binary")).alias("h2"), _shortest(w, i).alias("ahead"), _shortest(r, F.size(w) - 1 - i).alias("back"))))
    numbered = docs.select("doc_id", "text", positions().alias("doc"))
    out = numbered.select("doc_id", F.xxhash64("text").alias("text_hash"), "doc", F.posexplode(named(weights, rows)).alias("i", "line"))
    fits = F.when(F.col("i") < (1 << LINE_BITS) - MIN_WORDS, F.col("doc") + F.col("i")).otherwise(F.raise_error(F.lit("more lines in a text than positions can number")))
    return out.select(fits.alias("pos"), "doc", "doc_id", "text_hash", "line.*")


def _named_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``pos, name`` of the rows that share their keys with another."""
    groups = rows.groupBy(*keys).agg(F.min("pos").alias("name"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(groups, keys).select("pos", "name")


def suffix_classes(lines: DataFrame, longest: int = MIN_WORDS) -> DataFrame:
    """``k, pos, name``: classes of suffixes that share 2^k lines with another, up to the level ``longest`` needs."""
    level = saved(_named_groups(lines.select("pos", "h1", "h2"), ["h1", "h2"]), "suffixes-0")
    found = level.select(F.lit(0).alias("k"), "pos", "name")
    for k in range(1, longest.bit_length()):
        ahead = level.select((F.col("pos") - (1 << k - 1)).alias("pos"), F.col("name").alias("then"))
        level = saved(_named_groups(level.join(ahead, "pos").withColumnRenamed("name", "here"), ["here", "then"]), f"suffixes-{k}")
        if level.isEmpty():
            break
        found = found.unionByName(level.select(F.lit(k).alias("k"), "pos", "name"))
    return found


def repeated_runs(lines: DataFrame) -> DataFrame:
    """``start, lines, first``: qualifying runs that occur before, with their first occurrence."""
    ahead = lines.where("ahead > 0").select(F.col("pos").alias("start"), F.col("ahead").alias("lines"))
    back = lines.where("back > 1").select((F.col("pos") - F.col("back") + 1).alias("start"), F.col("back").alias("lines"))
    level = sum([F.when(F.col("lines") >= 1 << k, 1).otherwise(0) for k in range(1, MIN_WORDS.bit_length())], F.lit(0))
    runs = ahead.unionByName(back).withColumn("k", level)
    classes = suffix_classes(lines)
    left = classes.select("k", F.col("pos").alias("start"), F.col("name").alias("here"))
    right = classes.select("k", F.col("pos").alias("tail"), F.col("name").alias("then"))
    # a run of one, two, four ... lines is one class; any other is two overlapping ones
    met = runs.join(left, ["k", "start"]).withColumn("tail", F.col("start") + F.col("lines") - F.pow(F.lit(2.0), F.col("k")).cast("bigint"))
    met = saved(met.join(right, ["k", "tail"]).select("start", "lines", "here", "then"), "runs")
    first = met.groupBy("lines", "here", "then").agg(F.min("start").alias("first"))
    return met.join(first, ["lines", "here", "then"]).where("start > first").select("start", "lines", "first").distinct()


def deleted_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, gone``: sorted 0-based lines that go, for documents that lose any."""
    lines = saved(line_rows(docs), "lines")
    gone = repeated_runs(lines).select(F.explode(F.sequence(F.col("start"), F.col("start") + F.col("lines") - 1)).alias("pos"))
    low = (1 << LINE_BITS) - 1
    by_doc = gone.groupBy(F.col("pos").bitwiseAND(F.lit(~low)).alias("doc")).agg(F.array_sort(F.collect_set(F.col("pos").bitwiseAND(F.lit(low)).cast("int"))).alias("gone"))
    owners = lines.where("pos = doc").select("doc", "doc_id", "text_hash")
    # rows equal in id and text: the first one decides
    firsts = owners.groupBy("doc_id", "text_hash").agg(F.min("doc").alias("doc"))
    return firsts.join(by_doc, "doc").select("doc_id", "text_hash", "gone")


def without_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_lines, n_deleted, gone``: every row with its text after deletion."""
    gone = saved(deleted_lines(docs), "deleted").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text"), "gone")
    rows = docs.select("doc_id", "text")
    # both sides grow with the corpus, so they meet by a shuffle at every size
    joined = rows.join(gone.hint("merge"), rows["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64("text") == gone["_text"]), "left")
    lines = F.split("text", "\n")
    rest = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("gone", i)), "\n")
    return joined.select(
        "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(rest).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0)).alias("n_deleted"), F.array_join(F.col("gone").cast("array<string>"), ",").alias("gone"))
