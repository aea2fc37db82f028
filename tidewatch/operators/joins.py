"""Windowed and interval joins, enrichment, as-of lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.registry import small_side
from tidewatch.operators.windows import span_us, window_start


def window_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, width: str, how: str = "inner") -> DataFrame:
    """Equal keys inside the same tumbling window, as a plain equi-join on (keys, window).

    Columns of the two sides must differ in name apart from the keys.  Two streams need
    a watermark each; unmatched rows of an outer join carry nulls on the other side.
    """
    if left.isStreaming or right.isStreaming:
        # the window alone carries the watermark: a join may output one event-time column only
        a = left.withColumn("__w", F.window(left_ts, width)).withColumn(left_ts, _unmarked(left_ts))
        b = right.withColumn("__w", F.window(right_ts, width)).withColumn(right_ts, _unmarked(right_ts))
        return a.join(b, ["__w", *on], how).withColumn("window_start", F.col("__w.start")).drop("__w")
    a = left.withColumn("window_start", window_start(left_ts, width))
    b = right.withColumn("window_start", window_start(right_ts, width))
    return a.join(b, ["window_start", *on], how)


def interval_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, low: str, high: str, how: str = "inner"
) -> DataFrame:
    """Pairs with ``left_ts + low <= right_ts <= left_ts + high`` (``how``: inner or left).

    Bounded tables join on (keys, time bucket): every left row sits in one bucket, a right
    row is copied to the one or two buckets its partners can be in.  A busy key is thus
    spread over its buckets and never pairs all its rows.
    """
    if how not in ("inner", "left"):
        raise ValueError("interval_join takes inner or left")
    lo, hi = span_us(low), span_us(high)
    names = [f"__r_{k}" for k in on]
    other = right.withColumnsRenamed(dict(zip(on, names)))
    near = F.unix_micros(F.col(right_ts)).between(F.unix_micros(F.col(left_ts)) + lo, F.unix_micros(F.col(left_ts)) + hi)
    same = _equal(on, names)
    if left.isStreaming or right.isStreaming:
        near = (F.col(right_ts) >= F.col(left_ts) + F.expr(f"interval {lo} microseconds")) & (
            F.col(right_ts) <= F.col(left_ts) + F.expr(f"interval {hi} microseconds")
        )
        return left.join(other, same & near, how).withColumn(right_ts, _unmarked(right_ts)).drop(*names)
    width = max(hi - lo, 1_000_000)
    a = left.withColumn("__at", F.unix_micros(F.col(left_ts))).withColumn("__bucket", F.expr(f"(__at - pmod(__at, {width})) div {width}"))
    spread = other.withColumn("__at_r", F.unix_micros(F.col(right_ts)))
    first = f"((__at_r - {hi}) - pmod(__at_r - {hi}, {width})) div {width}"
    last = f"((__at_r - {lo}) - pmod(__at_r - {lo}, {width})) div {width}"
    b = spread.withColumn("__bucket_r", F.explode(F.expr(f"sequence({first}, {last})")))
    joined = a.join(b, same & (F.col("__bucket") == F.col("__bucket_r")) & near, how)
    return joined.drop("__bucket", "__bucket_r", "__at", "__at_r", *names)


def enrich(df: DataFrame, reference: DataFrame, on: str, defaults: dict[str, object], max_rows: int = 100_000) -> DataFrame:
    """Left join with a reference table, broadcast if it is counted to be small; gaps take the defaults."""
    joined = df.join(small_side(reference, max_rows), on, "left")
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()})


def _unmarked(ts: str) -> Column:
    """The same time as a column without a watermark."""
    return F.timestamp_micros(F.unix_micros(F.col(ts)))


def _equal(left: Sequence[str], right: Sequence[str]) -> Column:
    same = F.lit(True)
    for a, b in zip(left, right):
        same = same & (F.col(a) == F.col(b))
    return same
