"""Hospital reference data and lookups against a registry table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Region, hospitals of the region, beds per hospital.
HOSPITALS = [
    ("NE", ["HNE1", "HNE2", "HNE3", "HNE4"], 200),
    ("MW", ["HMW1", "HMW2", "HMW3"], 170),
    ("W", ["HW1", "HW2", "HW3", "HW4", "HW5"], 300),
    ("S", ["HS1", "HS2"], 100),
]
REGIONS = ["NE", "MW", "W", "S"]
ALERT_RATIO = 0.9
UNKNOWN_CAPACITY = -1

REGISTRY_SCHEMA = "hospitalID string, regionID string, maxCapacity int"


def hospital_registry(spark: SparkSession) -> DataFrame:
    rows = [(hospital, region, beds) for region, hospitals, beds in HOSPITALS for hospital in hospitals]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def with_registry(
    df: DataFrame,
    registry: DataFrame,
    key: str = "hospitalID",
    region: str = "regionID",
    capacity: str = "maxCapacity",
    max_rows: int = 100_000,
) -> DataFrame:
    """Add region and capacity; an unknown key gets a null region and capacity -1.

    The registry is broadcast only after counting that it has at most ``max_rows`` rows.
    """
    side = registry.select(F.col(key).alias("__rk"), F.col(region).alias("__rr"), F.col(capacity).alias("__rc"))
    joined = df.join(small_side(side, max_rows), F.col(key) == F.col("__rk"), "left")
    return joined.withColumns(
        {region: F.col("__rr"), capacity: F.coalesce(F.col("__rc"), F.lit(UNKNOWN_CAPACITY).cast("int"))}
    ).drop("__rk", "__rr", "__rc")


def small_side(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only if the table is counted to have at most ``max_rows`` rows.

    A larger table is returned as it is and joins through a shuffle.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
