"""Personal data and the terms that give it away, in DataFrame functions only.

Base spans (email, ip, card, phone) are found by pattern in the whole text. Every distinct value is a protected entity.
Co-occurrence over all documents tells how strongly a term reveals an entity: with ``IC(e) = -log p(e)`` and
``PMI(e, t) = log p(e, t) / (p(e) p(t))`` the disclosure ``PMI / IC`` is 1 when the term never occurs without the entity
and 0 when it says nothing. Terms above the upper threshold are removed, those between the thresholds are generalised
to their class. A term to remove is marked in every text, one to generalise in the texts of its entity. Estimates need ``MIN_TEXTS`` different texts, so that a text and its copies alone prove nothing.

Defined results: a null text is empty; repeated rows each get the same answer; an empty table gives an empty result.
Only the id and text columns are read, so further columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import named, saved
from meterline.llm.decontaminate import words

# The published patterns, written so that no text makes them backtrack. Runs are taken whole, and a match
# begins where a run begins or where the match before ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Cheap signs that a text may hold a kind at all.
SIGNS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": "+"}
PART = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"

MIN_TEXTS = 3
REMOVE_FROM = 0.95
GENERALISE_FROM = 0.8
BLOCK = 256
SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def prefix_sums(steps: Column) -> Column:
    """Running sums of an array of integers; work grows with ``n * BLOCK``, not with ``n * n``."""
    zero = F.array(F.lit(0))

    def append(acc: Column, x: Column) -> Column:
        return F.concat(acc, F.array(F.element_at(acc, -1) + x))

    def run(s: Column) -> Column:
        n = F.size(s)
        blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda b: F.slice(s, b * BLOCK + 1, F.lit(BLOCK)))

        def join(bs: Column) -> Column:
            bases = F.aggregate(F.transform(bs, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x)), zero, append)
            return named(bases, lambda base: F.flatten(F.transform(
                bs, lambda b, i: F.slice(F.aggregate(b, F.array(F.get(base, i)), append), 2, BLOCK))))
        return F.when(n > 0, named(blocks, join)).otherwise(F.array().cast("array<int>"))
    return named(steps, run)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap: value with start and end in code points."""
    def place(t: Column) -> Column:
        found, gaps = F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), F.split(t, pattern, -1)

        def pair(f: Column) -> Column:
            ends = prefix_sums(F.zip_with(F.slice(F.transform(gaps, lambda g: F.length(g)), F.lit(1), F.size(f)), F.transform(f, lambda v: F.length(v)), lambda g, v: g + v))
            return F.zip_with(f, ends, lambda v, e: F.struct((e - F.length(v)).alias("start"), e.alias("end"), v.alias("value")))
        return named(found, pair)
    return named(text, place)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def worth(i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.rlike(PART))
    if kind == "card":
        return F.when(F.length(_digits(value)).between(13, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All valid base spans of a text, by kind and then by start."""
    def of(kind: str, t: Column) -> Column:
        sign = t.contains(SIGNS[kind]) if len(SIGNS[kind]) == 1 else t.rlike(SIGNS[kind])
        found = F.filter(matches(t, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
        spans = F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")))
        return F.when(sign, spans).otherwise(F.array().cast(SPANS))
    return named(F.coalesce(text, F.lit("")), lambda t: F.concat(*[of(k, t) for k in KINDS]))


def _outside(text: Column) -> Column:
    """The text without what the base patterns match."""
    for pattern in PATTERNS.values():
        text = F.regexp_replace(text, pattern, " ")
    return text


def term_disclosure(found: DataFrame, docs: DataFrame) -> DataFrame:
    """``entity, term, disclosure`` of the terms above the lower threshold. ``found`` has the rows with base spans."""
    texts = found.groupBy("text_hash").agg(F.count("*").alias("copies"), F.first("text").alias("text"), F.first("spans").alias("spans"))
    entities = F.array_distinct(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["value"])))
    texts = saved(texts.select("text_hash", "copies", entities.alias("entities"), F.array_distinct(words(_outside(F.col("text")))).alias("terms")), "pii-texts")
    in_text = texts.select("text_hash", "copies", F.explode("entities").alias("entity"))
    protected = in_text.groupBy("entity").agg(F.count("*").alias("texts"), F.sum("copies").alias("df_e")).where(F.col("texts") >= MIN_TEXTS)
    kept = in_text.join(protected.select("entity"), "entity", "left_semi")
    pairs = (
        kept.join(texts.select("text_hash", "terms"), "text_hash").select("entity", "copies", F.explode("terms").alias("term"))
        .groupBy("entity", "term").agg(F.count("*").alias("texts"), F.sum("copies").alias("df_et")).where(F.col("texts") >= MIN_TEXTS)
    )
    pairs = saved(pairs.drop("texts"), "pii-pairs")
    # a table of its own, so that Catalyst knows its size: small ones filter the words where they are read, below the count
    terms = saved(pairs.select("term").distinct(), "pii-terms")
    everywhere = docs.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    df_t = everywhere.groupBy("term").agg(F.count("*").alias("df_t")).join(terms, "term", "left_semi")
    n = F.lit(float(max(docs.count(), 2)))
    ic = F.log(n / F.col("df_e"))
    pmi = F.log(F.col("df_et") * n / (F.col("df_e") * F.col("df_t")))
    return (
        pairs.join(df_t, "term").join(protected.select("entity", "df_e"), "entity").where(F.col("df_e") < n)
        .select("entity", "term", F.round(pmi / ic, 9).alias("disclosure")).where(F.col("disclosure") >= GENERALISE_FROM)
    )


def find(docs: DataFrame) -> DataFrame:
    """Per document row: ``doc_id, text_hash, base`` spans and ``terms``, the revealing spans with ``treatment``."""
    text = F.coalesce("text", F.lit(""))
    scanned = docs.select("doc_id", text.alias("t"), F.xxhash64(text).alias("text_hash"), base_spans(F.col("text")).alias("spans"))
    # the texts of documents with personal data are kept, so that counting terms need not look for them
    rows = saved(scanned.select("doc_id", "text_hash", "spans", F.when(F.size("spans") > 0, F.col("t")).alias("text")), "pii-base")
    found = rows.where("text IS NOT NULL")
    known = saved(term_disclosure(found, docs), "pii-known")
    beside = (
        found.select("text_hash", F.explode(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["value"]))).alias("entity")).distinct()
        .join(known, "entity").select("text_hash", "term", "disclosure")
    )
    flagged = saved(
        beside.unionByName(revealed(docs, known)).groupBy("text_hash", "term").agg(F.max("disclosure").alias("disclosure"))
        .groupBy("text_hash").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("disclosed")), "pii-flagged")
    spans = found.groupBy("text_hash").agg(F.first("spans").alias("spans"))
    # only texts with a term to mark are moved; their copies become one row in the tasks that read them
    held = docs.select(F.xxhash64(text).alias("text_hash"), text.alias("text")).join(flagged.select("text_hash"), "text_hash", "left_semi")
    texts = held.groupBy("text_hash").agg(F.first("text").alias("text"))
    marked = texts.join(flagged, "text_hash").join(spans, "text_hash", "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))
    marked = marked.select("text_hash", _term_spans().alias("terms")).where(F.size("terms") > 0)
    return rows.drop("text").withColumnRenamed("spans", "base").join(marked, "text_hash", "left").withColumn("terms", F.coalesce("terms", F.array().cast(f"{SPANS[:-2]},treatment:string>>")))


def revealed(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``text_hash, term, disclosure`` of the terms to remove in all texts, also in those that hold no entity: there the term is what reveals it."""
    telling = saved(known.where(F.col("disclosure") >= REMOVE_FROM).groupBy("term").agg(F.max("disclosure").alias("disclosure")), "pii-telling")
    told = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    return told.join(telling, "term").select("text_hash", "term", "disclosure")


def _term_spans() -> Column:
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = F.filter(matches(low, WORD), lambda m: F.map_contains_key("disclosed", m["value"]))
    apart = F.filter(seen, lambda m: ~F.exists("spans", lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"])))
    return F.transform(apart, lambda m: F.struct(
        F.lit("term").alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"),
        F.when(F.element_at("disclosed", m["value"]) >= REMOVE_FROM, "remove").otherwise("generalise").alias("treatment")))


def sanitise(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, text``: base spans become their kind, terms their class or nothing."""
    spot = F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("with"))),
        F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["treatment"] == "remove", "").when(s["value"].rlike("^[0-9]+$"), "[NUMBER]").otherwise("[TERM]").alias("with"))),
    )
    spots = found.groupBy("doc_id", "text_hash").agg(F.first(F.array_sort(spot)).alias("spots")).withColumnRenamed("doc_id", "_id")
    text = F.coalesce(docs["text"], F.lit(""))
    joined = docs.select("doc_id", "text").join(spots, docs["doc_id"].eqNullSafe(spots["_id"]) & (F.xxhash64(text) == spots["text_hash"]), "left")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def put(acc: Column, s: Column) -> Column:
        here = s["start"] >= acc["at"]
        piece = F.array(F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), s["with"])
        return F.struct(F.when(here, s["end"]).otherwise(F.greatest(acc["at"], s["end"])).alias("at"), F.when(here, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))
    rest = F.aggregate("spots", start, put, lambda a: F.array_join(F.concat(a["out"], F.array(F.substring(F.col("text"), a["at"] + 1, F.length("text")))), ""))
    return joined.select("doc_id", F.when(F.size("spots") > 0, rest).otherwise(F.col("text")).alias("text"))


def _written(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))


def digest(found: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = _written(F.col("base"))
    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, _written(F.col("terms"))), ",").alias("spans"))
