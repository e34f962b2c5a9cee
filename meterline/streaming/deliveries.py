"""Names of micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame


def delivery_id(batch: DataFrame, epoch: int) -> str:
    """Name of a micro-batch that is stable across restarts and new for a new checkpoint."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query_id:
        raise ValueError("not called from a streaming query")
    return f"{query_id}-{epoch}"
