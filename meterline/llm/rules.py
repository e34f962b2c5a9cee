"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule. A policy is a
named mask of rules that reject; applying another version, or asking what a rule alone rejects, is bitwise work on the
ledger and never reads a text again.

Defined results: a null or empty text has no words, fails the rule on few words and no ratio rule (a ratio without a
base is 0); repeated rows are judged one by one; an empty table gives an empty ledger. Only the id and text columns are
read, so further columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import named

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8

#: Name and condition of each rule; its place is its bit. Append only: stored ledgers keep their meaning.
RULES = (
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "n_symbols > 0.2 * n_words"),
    ("duplicate_lines", "n_dup_lines > 0.3 * n_lines"),
    ("capitals", "n_upper > 0.5 * word_chars"),
    ("long_words", "word_chars > 15 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("exclamations", "n_exclamations > 0.2 * n_words"),
    ("stuttering", "n_stutter > 0.2 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BIT[n] for n in names)


BASE = mask("few_words", "repeated_words")
#: Versions of the policy; a later one does not change an earlier one.
POLICIES = {
    "v1": BASE,
    "v2": BASE | mask("symbols", "capitals"),
    "v3": BASE | mask("symbols", "capitals", "long_words", "short_words", "exclamations", "stuttering"),
}


def _repeated(hashes: Column) -> Column:
    """Words in windows that occur twice or more."""
    windows = F.transform(
        F.when(F.size(hashes) >= REPEAT_WINDOW, F.sequence(F.lit(0), F.size(hashes) - REPEAT_WINDOW)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(REPEAT_WINDOW)]),
    )

    def count(w: Column) -> Column:
        ordered = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        def cover(p: Column) -> Column:
            steps = F.transform(p, lambda x, i: F.least(F.lit(REPEAT_WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(REPEAT_WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)
        # most texts repeat nothing; the cheap look at distinct windows comes first
        return F.when(F.size(F.array_distinct(w)) < F.size(w), named(named(ordered, places), cover)).otherwise(F.lit(0).cast("bigint"))
    return named(windows, count)


def _stutter(hashes: Column) -> Column:
    """Words equal to the word before."""
    return F.size(F.filter(hashes, lambda h, i: h == F.get(hashes, i - 1))).cast("bigint")


def measure(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def without(chars: str) -> Column:
        return F.length(text) - F.length(F.translate(text, chars, ""))
    return docs.select(
        "doc_id",
        named(hashes, lambda h: F.struct(F.size(h).cast("bigint").alias("n_words"), _repeated(h).alias("n_repeat_words"), _stutter(h).alias("n_stutter"))).alias("w"),
        (F.length(text) - without(SPACES)).cast("bigint").alias("word_chars"),
        without(SYMBOLS).cast("bigint").alias("n_symbols"),
        without("!").cast("bigint").alias("n_exclamations"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("bigint").alias("n_upper"),
        named(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"))).alias("l"),
    ).select("doc_id", "w.*", "word_chars", "n_symbols", "n_exclamations", "n_upper", "l.*")


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``failed``, the bits of the failed rules."""
    bits = [F.when(F.expr(condition), F.lit(BIT[name])).otherwise(F.lit(0)) for name, condition in RULES]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measure(docs).withColumn("failed", failed.cast("bigint"))


def rejected_by(policy: str) -> Column:
    return F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) != 0


def apply_policy(rows: DataFrame, policy: str = "v3") -> DataFrame:
    return rows.withColumn("base_failed", F.col("failed").bitwiseAND(F.lit(BASE)) != 0).withColumn("kept", ~F.col("base_failed") & ~rejected_by(policy))


def ablations(rows: DataFrame, policy: str = "v3") -> DataFrame:
    """Per rule of the policy: documents that fail it, and documents that only this rule rejects."""
    m = POLICIES[policy]
    sets = rows.groupBy(F.col("failed").bitwiseAND(F.lit(m)).alias("bits")).agg(F.count("*").alias("n"))
    names = [n for n, _ in RULES if BIT[n] & m]
    per_rule = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).cast("bigint").alias("bit")) for n in names])
    return (
        sets.select("bits", "n", F.explode(per_rule).alias("r"))
        .groupBy("r.rule").agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("failed_alone"),
        )
    )


def digest(judged: DataFrame) -> DataFrame:
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed", "n_upper",
        "n_exclamations", "n_stutter", "n_lines")
