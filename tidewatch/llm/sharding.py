"""Shards by rendezvous hashing of stable record keys, with gapless slots.

Every shard draws a number in (0, 1) for every key, from a hash of the two; the shard of
weight w with the greatest -w / ln(draw) gets the record.  A shard's scores do not depend on
which other shards there are, so one more shard takes records only into itself, a shard that
goes gives up only its own, and a raised weight only draws records in.  Shares are in
proportion to the weights.

Slots number the records of a shard from 0 without gaps, in the order asked for.  Records are
range-partitioned by shard and order, with the input's row number as the last tie, so no shard
and no key has to fit into a task; a record's slot is its place in its partition plus the
shard's records in earlier partitions, of which there is one count per partition and shard.

A null key hashes as the empty key: all such records go to one shard.  Repeated keys go to one
shard and get a slot each; rows equal in shard and order take slots in the order of the input.
An empty table gives an empty table.  A column of an output's name is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

#: hexadecimal digits of a draw (52 bits, exact in a double); low bits that hold a row's place in its partition
DRAW_DIGITS = 13
PLACE_BITS = 33


def draw(key: Column, shard: int) -> Column:
    """The shard's number for a key, strictly between 0 and 1."""
    text = F.concat_ws(":", F.lit(str(shard)), F.coalesce(key.cast("string"), F.lit("")))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_DIGITS), 16, 10).cast("double")
    return (number + 0.5) / F.lit(float(16**DRAW_DIGITS))


def score(key: Column, shard: int, weight: float) -> Column:
    return F.lit(-float(weight)) / F.ln(draw(key, shard))


def with_shard(df: DataFrame, key: str, weights: Sequence[float], shard: str = "shard") -> DataFrame:
    """The rows with the shard (0, 1, ...) that wins their key.  A shard of weight 0 gets nothing."""
    live = [(n, w) for n, w in enumerate(weights) if w]
    if not live or any(not 0 < w < float("inf") for _, w in live):
        raise ValueError("weights are finite, not negative and not all zero")
    scores = F.array(*(F.struct(score(F.col(key), n, w).alias("score"), F.lit(-n).alias("n")) for n, w in live))
    return df.withColumn(shard, (-F.array_max(scores)["n"]).cast("int"))


def with_slot(df: DataFrame, shard: str = "shard", order: Sequence[str] = ("doc_id",), slot: str = "slot") -> DataFrame:
    """The rows with their number in their shard, from 0, in the order of ``order`` (nulls first)."""
    df = df.drop(slot)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(parts, shard, *order, "__tie").sortWithinPartitions(shard, *order, "__tie")
    placed = stored(ranged.drop("__tie").withColumn("__place", F.monotonically_increasing_id()), "slots")
    part = F.shiftright("__place", PLACE_BITS).cast("int")
    held = placed.groupBy(part.alias("__part"), F.col(shard).alias("__shard")).agg(F.count("*").alias("__n"), F.min("__place").alias("__first"))
    before = Window.partitionBy("__shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # ranges meet at borders: at most as many rows as partitions and shards together
    starts = held.select("__part", "__shard", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), "__first")
    met = (F.col("__in") == F.col("__part")) & F.col(shard).eqNullSafe(F.col("__shard"))
    joined = placed.withColumn("__in", part).join(F.broadcast(starts), met)
    number = (F.col("__place") - F.col("__first") + F.col("__before")).cast("long")
    return joined.select(*df.columns, number.alias(slot))


def write_shards(df: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """Write the rows as one Parquet folder per shard, each file holding a stretch of slots in order.

    Rows that come from :func:`with_slot` are already in ranges of (shard, slot), so they are
    not shuffled again.
    """
    df.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
