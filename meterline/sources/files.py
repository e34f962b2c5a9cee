"""Monthly trip files: discovery, reading, curated output and bad-download detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterline.functions.numeric import nan_to_null
from meterline.schemas import RAW_TO_CURATED, RAW_TRIP
from meterline.sources.listing import list_tree

# Layout of the raw folder, and what a failed download looks like.
RAW_GLOB = "yellow/*/*/yellow_tripdata_*.parquet"
MONTH_PATTERN = r"yellow_tripdata_(\d{4})-(\d{2})\.parquet"
MIN_DOWNLOAD_BYTES = 1000
BAD_DOWNLOAD_PATTERN = "<Error>|<html>|Access Denied|404"


def month_of_path(path: Column) -> dict[str, Column]:
    """``year`` and ``month`` columns taken from a monthly file name."""
    return {
        "year": F.regexp_extract(path, MONTH_PATTERN, 1).try_cast("int"),
        "month": F.regexp_extract(path, MONTH_PATTERN, 2).try_cast("int"),
    }


def with_missing_columns(df: DataFrame) -> DataFrame:
    """Add raw columns a month does not have as typed NULLs; names compare without case."""
    present = {c.lower() for c in df.columns}
    curated = {raw.lower(): name.lower() for raw, name in RAW_TO_CURATED.items()}
    absent = {
        f.name: F.lit(None).cast(f.dataType)
        for f in RAW_TRIP.fields
        if f.name.lower() not in present and curated[f.name.lower()] not in present
    }
    return df.withColumns(absent) if absent else df


def with_source_columns(raw: DataFrame) -> DataFrame:
    """Row position and month of the file each row comes from; absent columns as NULLs."""
    raw = raw.withColumns(
        {"row_offset": F.col("_metadata.row_index"), **month_of_path(F.col("_metadata.file_name"))}
    )
    return nan_to_null(with_missing_columns(raw))


def read_raw_month(spark: SparkSession, path: str) -> DataFrame:
    """One raw month (or any glob of months) with its row position; a missing path is an error."""
    return with_source_columns(spark.read.parquet(path))


def read_all_months(spark: SparkSession, data_root: str) -> DataFrame:
    """Every raw month under ``data_root`` as one frame with ``year`` and ``month``.

    Month files drift in schema, so columns are merged by name.
    """
    return with_source_columns(spark.read.option("mergeSchema", "true").parquet(f"{data_root}/{RAW_GLOB}"))


def list_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Path, size and modification time of files; the content column is pruned from the scan."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def discover_months(spark: SparkSession, data_root: str) -> DataFrame:
    """One row per raw month file: path, year, month."""
    files = list_files(spark, f"{data_root}/yellow", "yellow_tripdata_*.parquet")
    return months_from_paths(files)


def months_from_paths(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Keep the paths that name a month and add ``year`` and ``month``."""
    return files.withColumns(month_of_path(F.col(path_col))).where("year is not null and month is not null")


def done_marker(curated_path: str, year: int, month: int) -> str:
    return f"{curated_path}/_done/{year}-{month:02d}"


def done_months(spark: SparkSession, curated_path: str) -> list[tuple[int, int]]:
    """Months with a marker: one name each."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{curated_path}/_done")
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in store.listStatus(folder)] if store.exists(folder) else []
    return [(int(y), int(m)) for y, _, m in (n.partition("-") for n in names)]


def pending_months(discovered: DataFrame, curated: DataFrame, force: bool = False) -> DataFrame:
    """Months still to curate: all of them when forced, else those without curated output."""
    if force:
        return discovered
    return discovered.join(curated.select("year", "month").distinct(), ["year", "month"], "left_anti")


def latest_file(files: DataFrame) -> DataFrame:
    """The most recently modified file."""
    return files.orderBy(F.desc("modificationTime"), "path").limit(1)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows in file order; the order must be unique to repeat."""
    return df.orderBy(*order).limit(n)


def write_curated(df: DataFrame, path: str) -> None:
    """Overwrite exactly the months present in ``df``; other months stay.

    ``rebalance`` lets the runtime split a month that dominates and join small ones, so file
    sizes do not follow the skew of the months.
    """
    (
        df.hint("rebalance", "year", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def suspicious_downloads(spark: SparkSession, path: str) -> DataFrame:
    """Files that are empty or small error pages, with the reason; nothing is deleted.

    The size filter is pushed down, so large files are not opened. Empty files, which file sources leave out, come from
    a listing in tasks.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .load(path).where(F.col("length") < MIN_DOWNLOAD_BYTES)
    ).select("path", "length", F.decode("content", "UTF-8").alias("content"))
    empty = list_tree(spark, path).where("NOT folder AND length = 0").select("path", "length", F.lit("").alias("content"))
    files = files.unionByName(empty)
    return files.select("path", "length", download_problem(F.col("length"), F.col("content")).alias("reason")) \
        .where("reason is not null")


def download_problem(length: Column, content: Column) -> Column:
    return F.when(length == 0, F.lit("empty")).when(
        (length < MIN_DOWNLOAD_BYTES) & content.rlike(BAD_DOWNLOAD_PATTERN), F.lit("error_page")
    )
