"""One registered query per text operator: its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import (
    chosen_path, collocations, decontaminate, grading, line_runs, mixing, neighbours, rules, sanitise, sharding, transcripts, warc, whitening,
)
from meterline.llm.common import prepare, table
from meterline.llm.oracle_sql import SQL  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def op1_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    return sharding.digest(sharding.vector_shards(table(prepare(spark), sf_dir, "documents"), 40))


#: Target shares of expected tokens: languages of good text, and what little of the rest is wanted.
MIX_TARGETS = {"en": 0.40, "de": 0.20, "fr": 0.20, "es": 0.15, "low": 0.03, "toxic": 0.02}


def op2_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents that bring the expected domain totals to the targets."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return mixing.digest(mixing.mix(docs, mixing.label_domains(docs, table(spark, sf_dir, "labels")), MIX_TARGETS))


def op3_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of all documents at a similarity of 0.8 on five-word shingles."""
    return chosen_path.digest(chosen_path.near_duplicates(table(prepare(spark), sf_dir, "documents")))


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back through the index."""
    return warc.digest(warc.write_archives(warc.plan_records(table(prepare(spark), sf_dir, "pages"))))


def op5_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns recovered from raw transcripts of all conversations."""
    lines = transcripts.raw_lines(table(prepare(spark), sf_dir, "conversations"))
    model = transcripts.train(transcripts.known_part(lines))
    return transcripts.digest(transcripts.turns(transcripts.label_lines(lines, model)))


def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and chance of being good of all documents."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return grading.score(docs, grading.train(docs, table(spark, sf_dir, "labels")))


def op7_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents and the terms that give it away."""
    return sanitise.digest(sanitise.find(table(prepare(spark), sf_dir, "documents")))


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later copies of repeated line runs."""
    return line_runs.without_runs(table(prepare(spark), sf_dir, "documents"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    prepare(spark)
    return decontaminate.digest(decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger and verdict of all documents under the newest policy."""
    return rules.digest(rules.apply_policy(rules.ledger(table(prepare(spark), sf_dir, "documents")), "v3"))


def op11_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language, from all documents."""
    return collocations.collocations(table(prepare(spark), sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their leading 16 whitened components."""
    return whitening.digest(whitening.whiten(table(prepare(spark), sf_dir, "embeddings")))


def op13_projected_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth embedding among all embeddings."""
    rows = table(prepare(spark), sf_dir, "embeddings")
    return neighbours.search(neighbours.build(rows), rows.where("vec_id % 20 = 0"))


QUERIES: dict[str, Query] = {
    "op1_vector_shards": op1_vector_shards,
    "op2_soft_mixing": op2_soft_mixing,
    "op3_chosen_path": op3_chosen_path,
    "op4_warc_index": op4_warc_index,
    "op5_transcripts": op5_transcripts,
    "op6_ordinal_quality": op6_ordinal_quality,
    "op7_disclosure": op7_disclosure,
    "op8_line_runs": op8_line_runs,
    "op9_winnowing": op9_winnowing,
    "op10_rule_ledger": op10_rule_ledger,
    "op11_stripes": op11_stripes,
    "op12_whitening": op12_whitening,
    "op13_projected_search": op13_projected_search,
}
