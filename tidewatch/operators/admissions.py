"""Windowed admission counts: per region, for one region, and over the whole network."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.registry import REGIONS
from tidewatch.operators.windows import tumbling

SENIOR_ABOVE = 65
INTERVAL = "2 minutes"


def count_where(*conditions: Column) -> Column:
    """Sum of how many of the conditions hold per row; a window without a match still counts 0."""
    parts = F.lit(0).cast("bigint")
    for condition in conditions:
        parts = parts + F.when(condition, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return F.sum(parts)


def senior(age: str = "age") -> Column:
    return F.col(age) > SENIOR_ABOVE


def measure_by_region(
    df: DataFrame, ts: str, region: str = "regionID", only: str | None = None, interval: str = INTERVAL, counted: Sequence[Column] | None = None
) -> DataFrame:
    """Counted admissions per window and region; with ``only``, of one region (rows of unknown region drop out)."""
    counted = [senior()] if counted is None else list(counted)
    rows = df.where(F.col(region) == only) if only is not None else df
    return tumbling(rows, ts, interval, [region], {"n": count_where(*counted)})


def measure_all_regions(
    df: DataFrame,
    ts: str,
    region: str = "regionID",
    regions: Sequence[str] = REGIONS,
    interval: str = INTERVAL,
    counted: Sequence[Column] | None = None,
) -> DataFrame:
    """Per window: the total, and every listed region's count in list order with 0 where it had none.

    A row of unknown region adds to the total only.
    """
    counted = [senior()] if counted is None else list(counted)
    own = F.lit(0).cast("bigint")
    for condition in counted:
        own = own + F.when(condition, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    per_region = {name: F.sum(F.when(F.col(region) == name, own).otherwise(F.lit(0).cast("bigint"))) for name in regions}
    return tumbling(df, ts, interval, [], {"total": F.sum(own), **per_region})


def share(count: Column, total: Column) -> Column:
    """Percentage of the total, 0 for an empty total."""
    return F.when(total > 0, count * 100.0 / total).otherwise(F.lit(0.0))


def counts_map(names: Sequence[str]) -> Column:
    """Count columns as one map from name to count, in the given order."""
    return F.create_map(*[part for name in names for part in (F.lit(name), F.col(name))])
