"""Bed occupancy: deferred emission, clamped running counts, hysteresis status, one-shot alerts."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.registry import ALERT_RATIO
from tidewatch.operators.timeline import Sample, Timeline, latest, previous, total

# Ratio to enter and to leave each status.
HIGH_ENTER, HIGH_EXIT = 0.90, 0.85
FULL_ENTER, FULL_EXIT = 1.00, 0.95


def closed_until(df: DataFrame, ts: str, delay_us: int = 1_000) -> int | None:
    """Watermark of a bounded table in microseconds: its latest event time minus the delay."""
    last = df.agg(F.max(F.unix_micros(F.col(ts))).alias("m")).first()["m"]
    return None if last is None else last - delay_us


def capacity_alerts(
    admissions: DataFrame, key: str, ts: str, capacity: str, ties: Sequence[str] = (), ratio: float = ALERT_RATIO, max_capacity: int | None = None
) -> DataFrame:
    """The first row per key whose running count reaches ``ratio`` of the capacity.

    Counts only grow, so only the first ``ratio * max_capacity`` rows of a key matter; the
    rank limit is applied in every map task before the shuffle.  A key without a positive
    capacity never alerts.
    """
    if max_capacity is None:
        max_capacity = admissions.agg(F.max(capacity).alias("m")).first()["m"] or 0
    enough = max(math.ceil(max(max_capacity, 0) * ratio) + 1, 1)
    first = Window.partitionBy(key).orderBy(ts, *ties)
    ranked = admissions.where(F.col(capacity) > 0).withColumn("occupied", F.row_number().over(first))
    reached = ranked.where(F.col("occupied") <= enough).withColumn("__ratio", F.col("occupied") / F.col(capacity))
    # the ratio at row n is n / capacity, so the alert row is the one that crosses the limit
    crossing = (F.col("__ratio") >= ratio) & ((F.col("occupied") - 1) / F.col(capacity) < ratio)
    return reached.where(crossing).withColumn("occupancy_pct", F.col("__ratio") * 100.0).drop("__ratio")


def pass_through(rows: DataFrame, alerts: DataFrame, tag: str = "tag") -> DataFrame:
    """Main output unchanged plus side output, as one tagged frame; split it with ``route``."""
    main = rows.withColumn(tag, F.lit("main"))
    return main.unionByName(alerts.withColumn(tag, F.lit("alert")), allowMissingColumns=True)


def deferred_emit(df: DataFrame, ts: str, wait_ms: Column, until_us: int | None = None, due: str = "due_time") -> DataFrame:
    """Emit every row again ``wait_ms`` after its event time, once the watermark has got there.

    ``until_us`` is the watermark; leave it out to emit all rows.
    """
    held = df.withColumn("__due", F.unix_micros(F.col(ts)) + wait_ms * 1000)
    if until_us is not None:
        held = held.where(F.col("__due") <= F.lit(until_us))
    return held.withColumn(due, F.timestamp_micros("__due")).drop("__due")


def deferred_emit_single(
    df: DataFrame, keys: Sequence[str], ts: str, wait_ms: Column, ties: Sequence[str], until_us: int | None = None, hot_rows: int | None = None
) -> DataFrame:
    """Deferred emission with one pending slot per key: a later arrival overwrites the slot.

    A timer emits what is in the slot and empties it.  In time order over arrivals and
    timers, a timer thus emits exactly when the entry before it is an arrival, and it emits
    that arrival.  At equal times arrivals come first.
    """
    payload = [c for c in df.columns if c not in keys]
    arrivals = df.withColumns({"__timer": F.lit(0), "__due": F.unix_micros(F.col(ts)) + wait_ms * 1000})
    arrivals = arrivals.withColumn("__at", F.col(ts))
    timers = arrivals.withColumns({"__timer": F.lit(1), "__at": F.timestamp_micros("__due")})
    if until_us is not None:
        timers = timers.where(F.col("__due") <= F.lit(until_us))
    line = Timeline.of(arrivals.unionByName(timers), keys, "__at", ["__timer", *ties], hot_rows)
    entry = F.struct("__timer", "__due", *payload)
    fired = line.scan(__before=previous(entry)).frame().where((F.col("__timer") == 1) & (F.col("__before.__timer") == 0))
    return fired.select(
        *keys,
        *[F.col(f"__before.{c}").alias(c) for c in payload],
        F.timestamp_micros("__before.__due").alias("due_time"),
        F.col("__at").alias("emitted_at"),
    )


def stay_deltas(admissions: DataFrame, discharges: DataFrame, keep: Sequence[str], admit_ts: str, discharge_ts: str) -> DataFrame:
    """Two typed inputs with a common key as one stream of +1 and -1 steps."""
    plus = admissions.select(*keep, F.col(admit_ts).alias("ts"), F.lit(1).alias("delta"))
    minus = discharges.select(*keep, F.col(discharge_ts).alias("ts"), F.lit(-1).alias("delta"))
    return plus.unionByName(minus)


def stay_steps(admissions: DataFrame, keep: Sequence[str], admit_ts: str, wait_ms: Column, until_us: int | None = None) -> DataFrame:
    """Both steps of each stay in one pass over the admissions: +1 on arrival, -1 when it is due."""
    start = F.unix_micros(F.col(admit_ts))
    due = start + wait_ms * 1000
    plus = F.struct(start.alias("us"), F.lit(1).alias("delta"))
    minus = F.struct(due.alias("us"), F.lit(-1).alias("delta"))
    if until_us is not None:
        minus = F.when(due <= F.lit(until_us), minus)
    steps = admissions.withColumn("__step", F.explode(F.filter(F.array(plus, minus), lambda s: s.isNotNull())))
    return steps.select(*keep, F.timestamp_micros("__step.us").alias("ts"), F.col("__step.delta").alias("delta"))


def occupancy(
    deltas: DataFrame, key: str, ts: str, delta: str, capacity: str, ties: Sequence[str] = (), hot_rows: int | None = None, measure: Sample | None = None
) -> Timeline:
    """Occupied beds after every step, floored at 0, with a flag where the floor was hit.

    Keys without a positive capacity are skipped before anything is counted.  At equal
    times admissions come before discharges.
    """
    known = deltas.where(F.col(capacity) > 0).withColumn("__last", -F.col(delta))
    line = Timeline.of(known, [key], ts, ["__last", *ties], hot_rows, measure)
    line = line.clamped_total(delta, "occupied", "underflow")
    return line.with_columns(occupied=F.col("occupied").cast("long"))


def status_latches(ratio: Column) -> dict[str, Column]:
    """Set/reset signals of the two latches (1 set, 0 reset, null keep)."""
    return {
        "__high": F.when(ratio >= HIGH_ENTER, F.lit(1)).when(ratio < HIGH_EXIT, F.lit(0)),
        "__full": F.when(ratio >= FULL_ENTER, F.lit(1)).when(ratio < FULL_EXIT, F.lit(0)),
    }


def status_of(high: Column, full: Column) -> Column:
    return F.when(full == 1, "FULL").when(high == 1, "HIGH").otherwise("NORMAL")


def status_changes(line: Timeline, ratio: Column) -> DataFrame:
    """Rows where the status NORMAL/HIGH/FULL changes, with the status before and after.

    The three-state hysteresis is two independent latches: HIGH sets at .90 and resets
    below .85, FULL sets at 1.00 and resets below .95.
    """
    signals = status_latches(ratio)
    line = line.scan(
        __h=latest(signals["__high"]),
        __f=latest(signals["__full"]),
        __hp=latest(signals["__high"], before=True),
        __fp=latest(signals["__full"], before=True),
    )
    changed = line.with_columns(
        previous_status=status_of(F.col("__hp"), F.col("__fp")), status=status_of(F.col("__h"), F.col("__f"))
    ).frame()
    return changed.where(F.col("status") != F.col("previous_status")).drop("__h", "__f", "__hp", "__fp")


def occupancy_alerts(
    deltas: DataFrame, key: str, ts: str, delta: str, capacity: str, ties: Sequence[str] = (), hot_rows: int | None = None, measure: Sample | None = None
) -> DataFrame:
    """Status changes of every key's occupancy, with beds, percentage and time."""
    line = occupancy(deltas, key, ts, delta, capacity, ties, hot_rows, measure)
    ratio = F.col("occupied").cast("double") / F.col(capacity)
    changes = status_changes(line, ratio)
    return changes.withColumn("occupancy_pct", ratio * 100.0).drop("__last", "underflow", delta)


def dynamic_capacity(
    deltas: DataFrame, updates: DataFrame, key: str, ts: str, delta: str, capacity: str, ties: Sequence[str] = (), hot_rows: int | None = None
) -> DataFrame:
    """Status changes when capacities change too: an update re-evaluates the key at once.

    ``updates`` has the key, the time, the ties and the new capacity.  Steps before a key's first
    update are ignored, as for an unknown key.  At equal times updates come first.
    """
    steps = deltas.withColumns({"__new": F.lit(None).cast("int"), "__order": F.when(F.col(delta) > 0, 1).otherwise(2)})
    sizes = updates.select(key, ts, *ties, F.col(capacity).cast("int").alias("__new")).withColumns(
        {delta: F.lit(0), "__order": F.lit(0)}
    )
    both = steps.drop(capacity).unionByName(sizes, allowMissingColumns=True)
    line = Timeline.of(both, [key], ts, ["__order", *ties], hot_rows)
    line = line.scan(**{capacity: latest("__new")})
    known = F.col(capacity) > 0
    line = line.with_columns(**{delta: F.when(known, F.col(delta)).otherwise(F.lit(0))})
    line = line.clamped_total(delta, "occupied", "__under")
    ratio = F.when(known, F.col("occupied").cast("double") / F.col(capacity))
    changes = status_changes(line.with_columns(occupied=F.col("occupied").cast("long")), ratio)
    return changes.withColumn("occupancy_pct", ratio * 100.0).drop("__new", "__order", "__under", delta)


def littles_law(
    deltas: DataFrame, key: str, ts: str, delta: str, ties: Sequence[str] = (), hot_rows: int | None = None, measure: Sample | None = None, aggs: Mapping[str, Column] | None = None
) -> DataFrame:
    """Time-weighted mean occupancy per key over the key's own span: area, span and arrivals.

    ``aggs`` are further aggregates of the steps, taken in the same pass.  Area is the sum of (occupancy before a step) x (time since the step before), in
    occupied-microseconds, kept as a whole number.
    """
    ordered = deltas.withColumn("__last", -F.col(delta))
    line = Timeline.of(ordered, [key], ts, ["__last", *ties], hot_rows, measure)
    line = line.scan(__level=total(F.col(delta).cast("long"), before=True), __prev=previous(ts))
    step = F.unix_micros(F.col(ts)) - F.unix_micros(F.col("__prev"))
    area = F.sum((F.coalesce(F.col("__level"), F.lit(0)) * F.coalesce(step, F.lit(0))).cast("decimal(38,0)"))
    return line.frame().groupBy(key).agg(
        area.alias("area_us"),
        (F.max(F.unix_micros(F.col(ts))) - F.min(F.unix_micros(F.col(ts)))).alias("span_us"),
        F.sum(F.when(F.col(delta) > 0, 1).otherwise(0)).alias("arrivals"),
        *[column.alias(name) for name, column in (aggs or {}).items()],
    )
