"""Key routing and how even it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.draw import key_number
from tidewatch.session import hot_rows as configured_hot_rows


def key_partition(df: DataFrame, *keys: str, n: int | None = None) -> DataFrame:
    """Rows with equal keys in one partition (null is a key too)."""
    return df.repartition(n, *keys) if n else df.repartition(*keys)


def spread_partition(df: DataFrame, *keys: str, row_id: str, n: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """Key routing for stateless work: a key longer than ``hot_rows`` is spread over ``shard`` pieces.

    ``shard`` is 0 for every other key, so ``(keys, shard)`` is the unit of co-location.
    """
    limit = hot_rows or configured_hot_rows(df.sparkSession)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    pieces = counted.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.ceil(F.col("__n") / limit).alias("__pieces"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    # at most rows / limit hot keys, so this side stays small however large the table is
    spread = df.join(F.broadcast(pieces), on, "left").withColumn(
        "shard", F.coalesce(F.pmod(key_number(row_id), F.col("__pieces")), F.lit(0).cast("bigint"))
    )
    spread = spread.drop("__pieces", *[f"__k_{k}" for k in keys])
    return key_partition(spread, *keys, "shard", n=n)


def worker_of(key: Column | str, workers: int) -> Column:
    """Stable worker number of a key."""
    return F.pmod(key_number(key), F.lit(workers)).cast("int")


def skew_report(df: DataFrame, key: str, workers: int) -> DataFrame:
    """Records per worker if ``key`` routed them, and the skew percentage.

    Skew is the coefficient of variation of the per-worker counts over its largest
    possible value (all rows on one worker): 0 is even, 100 is one busy worker.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    seen = per_key.groupBy(worker_of(key, workers).alias("worker")).agg(
        F.sum("__n").alias("records"), F.count(F.lit(1)).alias("distinct_keys")
    )
    everyone = Window.partitionBy()
    # idle workers count as zeros: sums run over the busy ones, the divisor is the worker count
    records = F.col("records").cast("double")
    rows, squares = F.sum(records).over(everyone), F.sum(records * records).over(everyone)
    variance = squares * F.lit(workers) / (rows * rows) - 1
    return seen.withColumn("skew_pct", F.sqrt(F.greatest(F.lit(0.0), variance) / F.lit(float(max(workers - 1, 1)))) * 100)


def two_stage_total(df: DataFrame, value: str, shard: Column, name: str = "total") -> DataFrame:
    """A global total by way of per-shard totals, so no worker sees all rows."""
    partial = df.groupBy(shard.alias("__shard")).agg(F.sum(value).alias("__sum"), F.count(F.lit(1)).alias("__n"))
    return partial.agg(F.sum("__sum").alias(name), F.sum("__n").alias("n_rows"))
