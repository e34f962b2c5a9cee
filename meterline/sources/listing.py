"""Listing of folder trees in tasks: one level of folders after another, a folder to a task row."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.session import work_dir

ENTRY = "path string, folder boolean, length bigint"
#: Entries that a task hands on at a time.
ENTRIES_PER_BATCH = 10_000


def list_tree(spark: SparkSession, path: str) -> DataFrame:
    """``path, folder, length`` of everything below a folder, in the form of path that Spark's file sources use.

    The driver only counts levels: the folders of a level are rows of a table, and the tasks that hold them list them with
    the Arrow file system of their scheme. A folder that is gone by then is empty. Entries are written to the shared folder
    level by level, so that a lost executor repeats its part of one level. The entries of a single folder are held by one task.
    """
    base = f"{work_dir(spark)}/listing/{uuid.uuid4().hex}"
    folders = spark.createDataFrame([(_qualified(path),)], "path string")
    levels = []
    while True:
        levels.append(f"{base}/level-{len(levels)}")
        spread = folders.repartition(F.xxhash64("path")) if len(levels) > 1 else folders
        spread.mapInArrow(_lister(), ENTRY).write.parquet(levels[-1])
        folders = spark.read.schema(ENTRY).parquet(levels[-1]).where("folder").select("path")
        if folders.isEmpty():
            return spark.read.schema(ENTRY).parquet(*levels)


def _qualified(path: str) -> str:
    """A path with its scheme; paths without one are local files."""
    if not urlsplit(path).scheme:
        return f"file:{path.rstrip('/') or '/'}"
    return path.rstrip("/") or path


def _lister():
    most = ENTRIES_PER_BATCH

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as fs

        for batch in batches:
            for folder in batch.column("path").to_pylist():
                scheme, _, rest = folder.partition(":")
                local = scheme == "file"
                system, inside = (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if local else fs.FileSystem.from_uri(folder)
                # what stands before the path inside the file system, to be put before what is found there
                prefix = "file:" if local else folder[: len(folder) - len(inside)]
                found = system.get_file_info(fs.FileSelector(inside, allow_not_found=True))
                for i in range(0, len(found), most):
                    part = found[i: i + most]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([prefix + f.path for f in part], pa.string()),
                        pa.array([f.type == fs.FileType.Directory for f in part], pa.bool_()),
                        pa.array([f.size for f in part], pa.int64()),
                    ], names=["path", "folder", "length"])
    return each
