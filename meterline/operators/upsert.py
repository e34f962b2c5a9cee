"""Last write wins, and merging by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order_by``, ties broken by the remaining columns.

    An aggregate rather than a ranking window: copies of a frequent key shrink to one row per
    task before the shuffle, so no key can fill a task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ranked = F.struct(*order_by, *rest)
    newest = df.groupBy(*keys).agg(F.max(ranked).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def merge_by_key(target: DataFrame, update: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` without a newer version, plus all of ``update`` (unique by key).

    Keys are unique on both sides, so the anti join has no hot key; a small update is broadcast
    by its measured size and the target is then not shuffled at all.
    """
    kept = target.join(update.select(*keys), list(keys), "left_anti")
    return kept.unionByName(update.select(*target.columns))
