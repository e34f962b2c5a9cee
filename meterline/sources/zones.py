"""Zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.schemas import FALLBACK_ZONES, ZONE, ZONE_CSV_TO_ZONE

_CSV_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    return standardize_zones(spark.read.csv(path, header=True, schema=_CSV_SCHEMA))


def standardize_zones(df: DataFrame) -> DataFrame:
    """File column names to dimension names, typed."""
    return df.select([F.col(src).cast(ZONE[dst].dataType).alias(dst) for src, dst in ZONE_CSV_TO_ZONE.items()])


def fallback_zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FALLBACK_ZONES, ZONE)


def seed_zones(existing: DataFrame, candidate: DataFrame) -> DataFrame:
    """Rows to insert: all candidates when the dimension is empty, none otherwise."""
    return candidate if existing.isEmpty() else candidate.limit(0)
