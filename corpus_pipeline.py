"""From documents to shards: the stages of a corpus pipeline, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.llm import chosen_path, decontaminate, grading, mixing, sharding
from meterline.llm.common import prepare, saved, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Shares of expected tokens by language.
LANGUAGES = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
#: No document is dropped to reach them; how often one is repeated follows from the targets alone.
LEAST_RATE, MOST_RATE = 1.0, float("inf")
SHARDS = 40


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier expects to be good."""
    return grading.select_good(docs, table(prepare(spark), sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    prepare(spark)
    return chosen_path.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, table(prepare(spark), sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; languages below their share are repeated until their expected tokens meet it."""
    labels = table(prepare(spark), sf_dir, "labels").where("quality = 1 AND coalesce(toxic, 0) = 0")
    domains = mixing.label_domains(docs, labels).where(F.col("y").isin(*LANGUAGES))
    return mixing.mixed_documents(docs, domains, LANGUAGES, LEAST_RATE, MOST_RATE, grow=True)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row that is left with its shard."""
    prepare(spark)
    return sharding.digest(sharding.vector_shards(docs, SHARDS))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near copies", one_of_each),
    ("benchmark", without_benchmark),
    ("mixing", mixed),
    ("shards", shards),
]

#: Iterative fits and greedy placement have no SQL form; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
