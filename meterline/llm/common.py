"""What several text operators share: tables in the shared folder, stable hashes, named array values."""

from __future__ import annotations

import sys
import uuid

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterline.session import configure, work_dir

# functions travel to the executors with their code, which need not have this package
cloudpickle.register_pickle_by_value(sys.modules["meterline.llm"])

#: Rows a Python task holds at once; texts may be long.
ROWS_PER_BATCH = "500"


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return spark


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that driver and executors share."""
    return f"{work_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it: lineage ends, and lost executors lose nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit integers; equal input, equal output on every machine."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered; forgets everything when it holds too many."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
