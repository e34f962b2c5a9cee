"""What the operators on embeddings share: which rows take part, and their vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def usable(rows: DataFrame, vector: str = "embedding", d: int | None = None) -> DataFrame:
    """``vec_id, v`` (doubles) of rows whose vector is there, of the usual length and wholly finite.

    The usual length is the commonest, and of equally common ones the longest: vectors of other lengths have no product or
    covariance with the rest. ``d`` asks for another length.
    """
    typed = rows.select("vec_id", F.col(vector).cast("array<double>").alias("v"))
    whole = typed.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", finite))
    if d is not None:
        return whole.where(F.size("v") == d)
    lengths = whole.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return whole.where(F.size("v") == (lengths[0]["d"] if lengths else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long vectors of a batch, one per row."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))
