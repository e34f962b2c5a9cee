"""Row shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns computed once per row, by a generator of one struct.

    As plain projections Catalyst would repeat the expressions inside every filter and derived
    column above. Use it for columns a real table would simply store.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
