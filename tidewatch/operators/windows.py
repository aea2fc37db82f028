"""Event-time windows.  Tumbling and session windows take batch and streaming rows alike."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.timeline import Sample, Timeline, latest, order_number, previous, tally, total

_UNIT_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def span_us(text: str) -> int:
    """"6 hours" as microseconds."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text)
    if not match or match.group(2) not in _UNIT_US:
        raise ValueError(f"not a span: {text!r}")
    return int(match.group(1)) * _UNIT_US[match.group(2)]


def shift(ts: Column | str, us: int) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(us))


def window_start(ts: Column | str, width: str) -> Column:
    """Start of the epoch-aligned tumbling window a time falls in."""
    us = span_us(width)
    at = F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)
    return F.timestamp_micros(at - F.pmod(at, F.lit(us)))


def tumbling(df: DataFrame, ts: str, width: str, keys: Sequence[str] = (), aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per window and key that received rows: bounds, keys, aggregates."""
    outputs = [column.alias(name) for name, column in (aggs or {"n": F.count(F.lit(1))}).items()]
    grouped = df.groupBy(F.window(ts, width).alias("__w"), *keys).agg(*outputs)
    return _with_bounds(grouped, keys)


def sliding(
    df: DataFrame, ts: str, width: str, slide: str, keys: Sequence[str] = (), parts: Mapping[str, tuple[str, str]] | None = None
) -> DataFrame:
    """Overlapping windows over mergeable parts: name -> ("sum" | "count" | "min" | "max", column).

    Bounded rows are first reduced to one row per key and slide-wide pane; only panes
    are copied to the windows they lie in.  Streams use the built-in sliding window.
    """
    parts = parts or {"n": ("count", ts)}
    if df.isStreaming or span_us(width) % span_us(slide):
        aggs = [getattr(F, kind)(column).alias(name) for name, (kind, column) in parts.items()]
        return _with_bounds(df.groupBy(F.window(ts, width, slide).alias("__w"), *keys).agg(*aggs), keys)
    step, copies = span_us(slide), span_us(width) // span_us(slide)
    panes = tumbling(df, ts, slide, keys, {name: getattr(F, kind)(column) for name, (kind, column) in parts.items()})
    back = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    placed = panes.withColumn("__back", back).withColumn(
        "window_start", F.timestamp_micros(F.unix_micros("window_start") - F.col("__back").cast("bigint") * F.lit(step))
    )
    merge = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    merged = placed.groupBy("window_start", *keys).agg(*[merge[kind](name).alias(name) for name, (kind, _) in parts.items()])
    return merged.select(
        "window_start", shift("window_start", span_us(width)).alias("window_end"), *keys, *parts
    )


def sessions(
    df: DataFrame, ts: str, gap: str, keys: Sequence[str], aggs: Mapping[str, Column], ties: Sequence[str] = (), hot_rows: int | None = None
) -> DataFrame:
    """One row per run of rows no further apart than ``gap``; the session ends one gap after its last row."""
    outputs = [column.alias(name) for name, column in aggs.items()]
    if df.isStreaming:
        grouped = df.groupBy(F.session_window(ts, gap).alias("__w"), *keys).agg(*outputs)
        return _with_bounds(grouped, keys, "session")
    marked = session_marks(Timeline.of(df, keys, ts, ties, hot_rows), gap).frame()
    grouped = marked.groupBy(*keys, "session_start").agg(F.max(ts).alias("__last"), *outputs)
    return grouped.select("session_start", shift("__last", span_us(gap)).alias("session_end"), *keys, *aggs)


def session_marks(line: Timeline, gap: str, at_gap: bool = False) -> Timeline:
    """Add ``session_start`` and ``session_opens`` (true on the first row of a session) to every row.

    Rows exactly one gap apart stay together; ``at_gap`` makes them start a new session.
    """
    ts = line.order
    apart = F.unix_micros(F.col(ts)) - F.unix_micros(F.col("__prev_ts"))
    parted = apart >= span_us(gap) if at_gap else apart > span_us(gap)
    line = line.scan(__prev_ts=previous(ts)).with_columns(session_opens=F.coalesce(parted, F.lit(True)))
    return line.scan(session_start=latest(F.when(F.col("session_opens"), F.col(ts)))).drop("__prev_ts")


def top_k(df: DataFrame, ts: str, width: str, keys: Sequence[str], k: int, by: str, ties: Sequence[str]) -> DataFrame:
    """The k largest rows per window and key.  Each map task keeps k rows per group before the shuffle."""
    placed = df.withColumn("window_start", window_start(ts, width))
    best = Window.partitionBy("window_start", *keys).orderBy(F.desc(by), *ties)
    return placed.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def crossings(averages: DataFrame, keys: Sequence[str], order: str, value: str, limit: float) -> DataFrame:
    """Rows where the value is above the limit and the key's previous value was not."""
    # one row per key and window: a key has no more rows than the time span has windows
    seen = Window.partitionBy(*keys).orderBy(order)
    rising = averages.withColumn("previous_value", F.lag(value).over(seen))
    return rising.where((F.col(value) > limit) & (F.col("previous_value") <= limit))


def early_counts(df: DataFrame, ts: str, width: str, every: str, keys: Sequence[str], value: Column) -> DataFrame:
    """Running count at each ``every`` mark from a window's first row on; the mark at the window end is final.

    ``every`` divides ``width``.  Marks without new rows repeat the count, so every window with
    a row has its final result.
    """
    marked = df.withColumns(
        {"window_start": window_start(ts, width), "fire_time": shift(window_start(ts, every), span_us(every))}
    ).withColumn("__v", value)
    parts = marked.groupBy("window_start", *keys, "fire_time").agg(F.sum("__v").alias("__part"))
    seen = Window.partitionBy("window_start", *keys).orderBy("fire_time")
    counted = parts.withColumns(
        {"partial_count": F.sum("__part").over(seen.rowsBetween(Window.unboundedPreceding, 0)), "__next": F.lead("fire_time").over(seen)}
    )
    end = shift("window_start", span_us(width))
    # a count holds until the mark before the next part, the last one until the window ends
    holds = F.coalesce(shift("__next", -span_us(every)), end)
    marks = F.sequence("fire_time", holds, F.expr(f"INTERVAL {every}"))
    return counted.select("window_start", *keys, F.explode(marks).alias("fire_time"), "partial_count").withColumn("is_final", F.col("fire_time") == end)


def fire_every_nth(
    df: DataFrame, ts: str, width: str, keys: Sequence[str], nth: int, ties: Sequence[str] = (), hot_rows: int | None = None, measure: Sample | None = None
) -> DataFrame:
    """A row each time a window's count reaches a multiple of ``nth``, and a final one per window.

    The final row is the window's last one with the whole count and ``is_final``, also where
    the count has just fired.
    """
    placed = df.withColumn("window_start", window_start(ts, width))
    if measure is not None:
        measure = Sample(measure.rows.withColumn("window_start", window_start(ts, width)), measure.weight)
    line = Timeline.of(placed, ["window_start", *keys], ts, ties, hot_rows, measure).scan(fired_count=tally(F.lit(True)))
    fired = line.frame().where(F.col("fired_count") % nth == 0).withColumn("is_final", F.lit(False))
    kept = [c for c in placed.columns if c not in ("window_start", *keys)]
    last = F.max_by(F.struct(*kept), F.struct(ts, *ties)).alias("__last")
    final = placed.groupBy("window_start", *keys).agg(last, F.count(F.lit(1)).alias("fired_count"), F.lit(True).alias("is_final"))
    return fired.unionByName(final.select("window_start", *keys, "__last.*", "fired_count", "is_final"))


#: ranges an unkeyed order is scanned in
RANGES = 64


def highest_before(df: DataFrame, order: str, value: Column, name: str, ranges: int = RANGES) -> DataFrame:
    """Add the largest ``value`` of all rows before a row in ``order``, over the whole table, without one task for it.

    Rows are scanned in ranges of the order cut at its quantiles (a sketch of one pass; where the
    cuts fall changes no result), and each range's maximum is carried to the later ones: a
    prefix scan over at most ``ranges`` rows.  Rows of one and the same place are one range's.
    """
    place = order_number(df, order)
    steps = [F.lit(k / ranges) for k in range(1, ranges)]
    cuts = df.agg(F.percentile_approx(place, F.array(*steps), F.lit(100 * ranges)).alias("c")).first()["c"]
    cuts = sorted(set(cuts or []))
    part = F.lit(0)
    for cut in cuts:
        part = part + (place > F.lit(cut)).cast("int")
    rows = df.withColumns({"__part": F.coalesce(part, F.lit(-1)), "__v": value})
    inside = Window.partitionBy("__part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    scanned = rows.withColumn("__in", F.max("__v").over(inside))
    tops = rows.groupBy("__part").agg(F.max("__v").alias("__top")).withColumn("__all", F.col("__part") < -1)
    earlier = Window.partitionBy("__all").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.broadcast(tops.select(F.col("__part").alias("__to"), F.max("__top").over(earlier).alias("__carry")))
    joined = scanned.join(carried, F.col("__part") == F.col("__to"))
    return joined.withColumn(name, F.greatest("__carry", "__in")).drop("__part", "__v", "__in", "__to", "__carry")


def late_routes(df: DataFrame, ts: str, arrival: str, width: str, bound: str, lateness: str, ranges: int = RANGES) -> DataFrame:
    """Where each row goes when rows come in ``arrival`` order.

    The watermark a row meets is the largest earlier event time minus ``bound``.  A row
    whose window ends after it is ``on_time``; up to ``lateness`` past the end the window
    fires again (``refire``); after that the row goes to the ``late`` side.
    """
    routed = highest_before(df, arrival, F.unix_micros(F.col(ts)), "__max", ranges).withColumn("window_start", window_start(ts, width))
    mark = F.col("__max") - span_us(bound)
    end = F.unix_micros(F.col("window_start")) + span_us(width)
    return routed.withColumn(
        "route",
        F.when(mark.isNull() | (end > mark), "on_time").when(end + span_us(lateness) > mark, "refire").otherwise("late"),
    ).drop("__max")


def rolling_sum(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, period: str, ties: Sequence[str], hot_rows: int | None = None
) -> DataFrame:
    """Per row, sum and count of the key's rows in the last ``period``, both ends included.

    Each row enters the running sum at its time and leaves it just after ``time + period``,
    so the range frame becomes one ordered running sum that can be split.
    """
    return _rolled(df, keys, ts, value, shift(ts, span_us(period)), 1, ties, hot_rows)


def rolling_panes(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, pane: str, panes: int, ties: Sequence[str], hot_rows: int | None = None
) -> DataFrame:
    """Per row, sum and count of the key's rows so far in the last ``panes`` panes, the present one included.

    A pane's rows leave together when the pane falls out, before the rows of that moment enter.
    """
    return _rolled(df, keys, ts, value, shift(window_start(ts, pane), panes * span_us(pane)), -1, ties, hot_rows)


def _rolled(df: DataFrame, keys: Sequence[str], ts: str, value: str, out: Column, turn: int, ties: Sequence[str], hot_rows: int | None) -> DataFrame:
    """Running sums over rows that enter at ``ts`` and leave at ``out``, after (1) or before (-1) what enters then."""
    entering = df.withColumns({"__leaves": F.lit(0), "__at": F.col(ts), "__v": F.col(value), "__c": F.lit(1).cast("bigint")})
    leaving = df.withColumns({"__leaves": F.lit(turn), "__at": out, "__v": -F.col(value), "__c": F.lit(-1).cast("bigint")})
    line = Timeline.of(entering.unionByName(leaving), keys, "__at", ["__leaves", *ties], hot_rows)
    summed = line.scan(rolling_sum=total("__v"), rolling_count=total("__c")).frame()
    return summed.where(F.col("__leaves") == 0).drop("__leaves", "__at", "__v", "__c")


def _with_bounds(grouped: DataFrame, keys: Sequence[str], prefix: str = "window") -> DataFrame:
    outputs = [c for c in grouped.columns if c != "__w" and c not in keys]
    return grouped.select(
        F.col("__w.start").alias(f"{prefix}_start"), F.col("__w.end").alias(f"{prefix}_end"), *keys, *outputs
    )
