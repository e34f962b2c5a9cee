"""Small steps on the file system that Spark uses: marker files, short texts, renames, tables kept for several passes."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from meterline.session import work_dir


def _at(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def touch(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.create(at, True).close()


def remove_path(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Rename a file or folder; the new name must be free."""
    fs, at = _at(spark, old)
    _, to = _at(spark, new)
    if fs.exists(to) or not (fs.mkdirs(to.getParent()) and fs.rename(at, to)):
        raise OSError(f"cannot rename {old} to {new}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def bytes_under(spark: SparkSession, path: str) -> int:
    fs, at = _at(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def release_shuffles(spark: SparkSession) -> None:
    """Shuffle files go when the driver collects the plans that made them, by itself perhaps long after; this asks for it now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _at(spark, path)
    source = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Readers see the whole text or no file: it is written under another name first."""
    fs, at = _at(spark, f"{path}.tmp")
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename_path(spark, f"{path}.tmp", path)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it: several passes over it repeat neither its joins nor their shuffles."""
    path = f"{work_dir(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
