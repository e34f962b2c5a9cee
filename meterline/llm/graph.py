"""Connected components by contraction; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterline.llm.common import saved


def _loose(edges: DataFrame) -> DataFrame:
    """Each edge once, smaller end first, without loops."""
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``v, label`` from edges ``a, b``; the label is the smallest vertex of the component.

    In a round every vertex moves to its smallest neighbour's smallest neighbour, if that is smaller, and the edges move
    with their ends. Edges inside what has met vanish, so later rounds see a fraction of the graph.
    """
    labels = None
    left = saved(_loose(edges), "edges")
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("low")).select("v", F.least("v", "low").alias("low")), "least")
        step = saved(least.join(least.select(F.col("v").alias("low"), F.col("low").alias("to")), "low").select("v", "to"), "step")
        if labels is None:
            labels = step.select("v", F.col("to").alias("label"))
        else:
            moved = labels.join(step.withColumnRenamed("v", "label"), "label", "left")
            labels = saved(moved.select("v", F.coalesce("to", "label").alias("label")), "labels")
        ends = left.join(step.select(F.col("v").alias("a"), F.col("to").alias("ta")), "a").join(step.select(F.col("v").alias("b"), F.col("to").alias("tb")), "b")
        left = saved(_loose(ends.select(F.col("ta").alias("a"), F.col("tb").alias("b"))), "edges")
        if left.isEmpty():
            return labels
