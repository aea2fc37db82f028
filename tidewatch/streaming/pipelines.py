"""Streaming forms of the keyed-state operators: wire a stream into a processor."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import news2
from tidewatch.functions.registry import ALERT_RATIO
from tidewatch.operators import rules as rule_ops
from tidewatch.operators.paging import PAGE_SIZE, REPEAT_WITHIN
from tidewatch.operators.windows import sliding, span_us, window_start
from tidewatch.streaming import live
from tidewatch.streaming import processors as p

NEVER_US = 2**62
SLOT = "1 minute"


def run(rows: DataFrame, keys: str | Sequence[str], processor, output: str, mode: str = "append", time: str = "EventTime") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode=mode, timeMode=time
    )


def _ms(span: str) -> int:
    return span_us(span) // 1000


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts)).alias("us")


def _kind(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def _at(df: DataFrame, ts: str = "ts", us: str = "us") -> DataFrame:
    return df.withColumn(ts, F.timestamp_micros(us)).drop(*([us] if us != ts else []))


def occupancy_alerts(
    admissions: DataFrame, key: str, ts: str, wait_ms: Column, capacity: str, region: str, tie: str, slot: str = SLOT, shards: int = 16
) -> DataFrame:
    """Admissions in, status changes out, when the watermark passes them.

    The stay is a pure function of the row, so both steps of a stay are known on arrival.  They
    wait in ``shards`` parts of each key; the key's own state only sees steps whose time has come.
    """
    start = F.unix_micros(F.col(ts))
    plus = F.struct(start.alias("us"), F.lit(-1).alias("last"))
    minus = F.struct((start + wait_ms * 1000).alias("us"), F.lit(1).alias("last"))
    steps = admissions.where(F.col(capacity) > 0).withColumn("__step", F.explode(F.array(plus, minus)))
    rows = steps.select(
        key, F.pmod(F.xxhash64(F.col(tie)), F.lit(shards)).alias("shard"), ts, "__step.us", "__step.last", F.col(tie).alias("tie"),
        F.col(capacity).alias("capacity"), F.col(region).alias("region"),
    )
    waiting = p.ReleasedSteps(key, _ms(slot))
    released = rows.groupBy(key, "shard").transformWithStateInPandas(
        statefulProcessor=waiting, outputStructType=waiting.OUTPUT.format(key=key), outputMode="append", timeMode="EventTime", eventTimeColumnName="due"
    )
    out = run(released, key, p.OccupancyMonitor(key), p.OccupancyMonitor.OUTPUT.format(key=key), time="None")
    return _at(out).withColumn("occupancy_pct", F.col("occupied").cast("double") / F.col("capacity") * 100.0)


def capacity_alerts(admissions: DataFrame, key: str, ts: str, capacity: str, tie: str, ratio: float = ALERT_RATIO) -> DataFrame:
    """All admissions (tag ``main``) and one alert per key (tag ``alert``); split with ``route``."""
    rows = admissions.select(key, ts, micros(ts), F.col(tie).alias("tie"), F.col(capacity).alias("capacity"))
    output = f"{key} {_kind(rows, key)}, us bigint, tie bigint, capacity int, tag string, occupied bigint"
    return _at(run(rows, key, p.CapacityAlert(key, ratio), output, time="None"))


def deferred_emit(df: DataFrame, key: str, ts: str, wait_ms: Column, payload: Sequence[str], slot: str = SLOT, spread: str | None = None, shards: int = 64) -> DataFrame:
    """Every row again once the watermark reaches its event time plus ``wait_ms``.

    Rows wait per ``key``.  Where keys are few and busy, rows wait in ``shards`` parts by a hash of
    the column ``spread`` instead, and the key goes along.
    """
    held = [*payload, key] if spread else list(payload)
    kinds = [(c, _kind(df, c)) for c in held]
    due = (F.unix_micros(F.col(ts)) + wait_ms * 1000).alias("us")
    if spread:
        place, kind = "__shard", "bigint"
        rows = df.select(F.pmod(F.xxhash64(spread), F.lit(shards)).alias(place), ts, due, *held)
    else:
        place, kind = key, _kind(df, key)
        rows = df.select(key, ts, due, *held)
    output = ", ".join([f"{place} {kind}", "us bigint", *[f"{n} {k}" for n, k in kinds]])
    out = _at(run(rows, place, p.DeferredEmit(place, kinds, _ms(slot)), output), "due_time")
    return out.drop(place) if spread else out


def deferred_slot(df: DataFrame, key: str, ts: str, wait_ms: Column, payload: Sequence[str]) -> DataFrame:
    """Deferred emission with one pending slot per key."""
    kinds = [(c, _kind(df, c)) for c in payload]
    due = (F.unix_micros(F.col(ts)) + wait_ms * 1000).alias("due_us")
    rows = df.select(key, ts, micros(ts), due, *payload)
    output = ", ".join([f"{key} {_kind(df, key)}", "due_us bigint", *[f"{n} {k}" for n, k in kinds], "fired_ms bigint"])
    return _at(run(rows, key, p.DeferredSlot(key, kinds), output), "due_time", "due_us")


def silence_resume(df: DataFrame, key: str, ts: str, gap: str, slot: str = SLOT) -> DataFrame:
    rows = df.select(key, ts, micros(ts))
    output = f"{key} {_kind(df, key)}, alert string, us bigint"
    return _at(run(rows, key, p.SilenceDetector(key, span_us(gap), _ms(slot)), output), "alert_time")


def idle_keys(df: DataFrame, key: str, gap: str) -> DataFrame:
    """Silence by processing time: what a live monitor needs, and not repeatable."""
    output = f"{key} {_kind(df, key)}, alert string, ms bigint"
    return run(df.select(key), key, p.IdleDetector(key, span_us(gap) // 1000), output, mode="update", time="ProcessingTime")


def sustained_breach(df: DataFrame, key: str, ts: str, breach: Column, sustain: str, tie: str, slot: str = SLOT) -> DataFrame:
    rows = df.select(
        key, ts, micros(ts), F.col(tie).alias("tie"), F.lit("breach").alias("rule"), F.coalesce(breach, F.lit(False)).alias("breach"),
        F.lit(span_us(sustain)).alias("wait_us"), F.lit(NEVER_US).alias("limit_us"),
    )
    return _breaches(rows, key, slot).drop("rule")


def sustained_rule_breach(matched: DataFrame, key: str, ts: str, tie: str, us_per_second: int = 1_000_000, slot: str = SLOT) -> DataFrame:
    """Readings matched to rules (and care plans) in, sustained alerts per rule out."""
    rows = matched.select(
        key, ts, micros(ts), F.col(tie).alias("tie"), F.col("ruleId").alias("rule"),
        rule_ops.outside(F.col("value"), F.col("min"), F.col("max")).alias("breach"),
        (F.col("rule_sustainSeconds").cast("bigint") * us_per_second).alias("wait_us"),
        F.coalesce(F.unix_micros("rule_life_end"), F.lit(NEVER_US)).alias("limit_us"),
    )
    return _breaches(rows, key, slot).withColumnRenamed("rule", "ruleId")


def _breaches(rows: DataFrame, key: str, slot: str) -> DataFrame:
    output = f"{key} {_kind(rows, key)}, rule string, start_us bigint, us bigint"
    out = run(rows, key, p.SustainedBreach(key, _ms(slot)), output)
    return _at(_at(out, "breach_start", "start_us"), "alert_time")


def news2_scores(
    df: DataFrame, patient: str, ts: str, code: str, value: str, tie: str,
    fresh_for: str = "5 minutes", notice_every: str = "1 minute", evict_after: str = "30 minutes", slot: str = SLOT,
) -> DataFrame:
    """Score changes (tag ``score``) and missing-sign notices (tag ``unavailable``)."""
    points = news2.points_by_code(F.col(code), F.col(value).cast("double")).alias("points")
    rows = df.select(patient, ts, micros(ts), F.col(tie).alias("tie"), F.col(code).alias("code"), points).where(F.col("points").isNotNull())
    signs = ", ".join(f"{sign.lower()}_points int" for sign in p.News2Scorer.SIGNS)
    output = f"{patient} {_kind(df, patient)}, us bigint, tie bigint, tag string, total int, band string, missing string, {signs}"
    scorer = p.News2Scorer(patient, span_us(fresh_for), span_us(notice_every), span_us(evict_after), _ms(slot))
    return _at(run(rows, patient, scorer, output))


def pages(
    alerts: DataFrame, shard: str, ts: str, who: Column, urgent: Column, tie: str, within: str = REPEAT_WITHIN, size: int = PAGE_SIZE, slot: str = SLOT
) -> DataFrame:
    """One row per paged alert with the page it went out on."""
    rows = alerts.select(shard, ts, micros(ts), F.col(tie).alias("tie"), who.alias("who"), urgent.alias("urgent"))
    output = f"{shard} {_kind(alerts, shard)}, page bigint, us bigint, tie bigint, who string, flushed_us bigint"
    out = run(rows, shard, p.Pager(shard, span_us(within), size, _ms(slot)), output)
    return _at(_at(out), "flushed_at", "flushed_us")


def expiring_sum(df: DataFrame, key: str, ts: str, amount: str, ttl: str, tie: str, slot: str = SLOT) -> DataFrame:
    rows = df.select(key, ts, micros(ts), F.col(tie).alias("tie"), F.col(amount).alias("amount"))
    output = f"{key} {_kind(df, key)}, us bigint, tie bigint, live_sum bigint, live_count bigint"
    return _at(run(rows, key, p.ExpiringSum(key, span_us(ttl), _ms(slot)), output))


def early_fire(df: DataFrame, key: str, ts: str, width: str, nth: int) -> DataFrame:
    rows = df.select(key, ts, F.unix_micros(window_start(ts, width)).alias("start_us"))
    output = f"{key} {_kind(df, key)}, start_us bigint, n bigint, is_final boolean"
    return _at(run(rows, [key, "start_us"], p.CountTrigger(key, nth, span_us(width)), output), "window_start", "start_us")


def late_routes(df: DataFrame, shard: str, ts: str, width: str, bound: str, lateness: str, kept: str, tie: str) -> DataFrame:
    """Rows with their route; declare the watermark of ``df`` with a delay of ``kept``.

    Rows later than ``kept`` are dropped by Spark and counted in the query progress.
    """
    rows = df.select(shard, ts, micros(ts), F.col(tie).alias("tie"))
    ahead = (span_us(kept) - span_us(bound)) // 1000
    output = f"{shard} {_kind(df, shard)}, us bigint, tie bigint, route string"
    router = p.LateRouter(shard, ahead, span_us(width), span_us(lateness))
    return _at(run(rows, shard, router, output))


def baseline_outliers(df: DataFrame, key: str, ts: str, value: str, tie: str, sigmas: float = 3.0, slot: str = SLOT) -> DataFrame:
    rows = df.select(key, ts, micros(ts), F.col(tie).alias("tie"), F.col(value).cast("double").alias("x"))
    output = f"{key} {_kind(df, key)}, us bigint, tie bigint, baseline_n bigint, is_outlier boolean"
    return _at(run(rows, key, p.BaselineOutliers(key, sigmas, _ms(slot)), output))


def sliding_crossings(df: DataFrame, key: str, ts: str, width: str, slide: str, value: str, limit: float) -> DataFrame:
    """Sliding average per key, then an alert when it rises above ``limit``."""
    slid = sliding(df, ts, width, slide, [key], {"s": ("sum", value), "n": ("count", value)})
    rows = slid.select(key, micros("window_start"), (F.col("s").cast("double") / F.col("n")).alias("x"))
    output = f"{key} {_kind(df, key)}, us bigint, x double, previous_value double"
    return _at(run(rows, key, p.CrossingAlert(key, limit), output, time="None"), "window_start")


def with_live_rules(
    read_rules: Callable[[SparkSession], DataFrame], ts: str, deliver: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that matches every micro-batch with the rules as they are then.

    The rule table is read anew for each batch, so a change applies from the next batch on
    without a restart.
    """

    def consume(batch: DataFrame, batch_id: int) -> None:
        deliver(rule_ops.threshold_alerts(batch, read_rules(batch.sparkSession), ts), batch_id)

    return consume


def dynamic_capacity(
    admissions: DataFrame, updates: DataFrame, key: str, ts: str, wait_ms: Column, capacity: str, tie: str, slot: str = SLOT
) -> DataFrame:
    """Admissions and capacity updates in, status changes out; an update re-evaluates its key at once.

    Both inputs declare a watermark.  What holds is the smaller one, so results wait for the
    input that is behind.
    """
    start = F.unix_micros(F.col(ts))
    plus = F.struct(start.alias("us"), F.lit(1).alias("turn"), F.lit(1).alias("delta"))
    minus = F.struct((start + wait_ms * 1000).alias("us"), F.lit(2).alias("turn"), F.lit(-1).alias("delta"))
    steps = admissions.where(F.col(key).isNotNull()).withColumn("__step", F.explode(F.array(plus, minus))).select(
        key, ts, "__step.us", "__step.turn", F.col(tie).alias("tie"), "__step.delta", F.lit(None).cast("int").alias("size")
    )
    sizes = updates.select(
        key, ts, micros(ts), F.lit(0).alias("turn"), F.col(tie).alias("tie"), F.lit(0).alias("delta"), F.col(capacity).cast("int").alias("size")
    )
    out = run(steps.union(sizes), key, live.DynamicCapacity(key, _ms(slot)), live.DynamicCapacity.OUTPUT.format(key=key))
    return _at(out).withColumn("occupancy_pct", F.col("occupied").cast("double") / F.col("capacity") * 100.0)


def rule_monitor(
    readings: DataFrame, commands: DataFrame, ts: str, tie: str, defaults: Sequence[tuple] = (), shards: int = 64, us_per_second: int = 1_000_000, slot: str = SLOT
) -> DataFrame:
    """Readings and live rule commands in; tagged ``alert``, ``suppressed`` and ``sustained`` rows out.

    ``commands`` are parsed rule and care-plan lines (:func:`tidewatch.functions.frames.parse_rules`)
    with a watermark of their own.  Patients are spread over ``shards`` keys, and each command goes
    to every shard: commands are few, readings are many.  ``defaults`` are tuples (rule, ward, vital,
    min, max, sustain seconds).
    """
    nothing = {name: F.lit(None).cast(kind) for name, kind in live.RuleMonitor.PAYLOAD}
    names = ["shard", ts, "us", *nothing]

    def laid_out(rows: DataFrame, given: dict[str, Column]) -> DataFrame:
        columns = nothing | given
        return rows.select(columns.pop("shard").alias("shard"), ts, micros(ts), *[columns[n].cast(k).alias(n) for n, k in live.RuleMonitor.PAYLOAD])

    data = laid_out(
        readings,
        {
            "shard": F.pmod(F.xxhash64("patientId"), F.lit(shards)), "turn": F.lit(1), "tie": F.col(tie), "kind": F.lit("READING"), "who": F.col("patientId"),
            "ward": F.col("wardId"), "vital": F.col("vitalCode"), "value": F.col("value"),
        },
    )
    copied = commands.withColumn("__shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))))
    control = laid_out(
        copied,
        {
            "shard": F.col("__shard"), "turn": F.lit(0), "tie": F.lit(0), "kind": F.concat("kind", F.when(F.col("op") == "DELETE", "_DELETE").otherwise("")),
            "who": F.col("patientId"), "ward": F.col("wardId"), "vital": F.col("vitalCode"), "rule": F.col("ruleId"), "low": F.col("min"), "high": F.col("max"),
            "wait_us": F.col("sustainSeconds").cast("bigint") * us_per_second,
        },
    )
    rows = data.select(names).union(control.select(names))
    held = [(rule, ward, vital, low, high, seconds * us_per_second) for rule, ward, vital, low, high, seconds, *_ in defaults]
    out = run(rows, "shard", live.RuleMonitor("shard", held, _ms(slot)), live.RuleMonitor.OUTPUT.format(key="shard"))
    named = out.select("tag", F.col("who").alias("patientId"), F.col("rule").alias("ruleId"), "us", "start_us", F.col("tie").alias(tie), "value", "by_plan")
    return _at(_at(named, "breach_start", "start_us"), "alert_time")


def rolling_panes(df: DataFrame, key: str, ts: str, amount: str, pane: str, panes: int, tie: str, slot: str = SLOT) -> DataFrame:
    """Per row, sum and count of the key's last ``panes`` panes of time; state grows with panes, not rows."""
    rows = df.select(key, ts, micros(ts), F.col(tie).alias("tie"), F.col(amount).alias("amount"))
    output = f"{key} {_kind(df, key)}, us bigint, tie bigint, rolling_sum bigint, rolling_count bigint"
    return _at(run(rows, key, live.RollingPanes(key, span_us(pane), panes, _ms(slot)), output))


def running_moments(df: DataFrame, key: str, ts: str, value: Column, width: str, spread: Column, salts: int = 32) -> DataFrame:
    """Count, mean, variance and maximum of whole-number values so far per key, at the end of every window.

    Windows are first aggregated per key and salt (a hash of ``spread``), so a busy key's rows
    meet in many tasks; per window at most ``salts`` parts of a key reach its one running state.
    """
    salted = df.withColumns({"__v": value.cast("bigint"), "__salt": F.pmod(F.xxhash64(spread), F.lit(salts))}).where(F.col("__v").isNotNull())
    wide = F.col("__v").cast("decimal(19,0)")
    parts = salted.groupBy(F.window(ts, width).alias("__w"), key, "__salt").agg(
        F.count("__v").alias("n"), F.sum(wide).cast("decimal(38,0)").alias("s"), F.sum(wide * wide).alias("q"), F.max("__v").alias("hi")
    )
    rows = parts.select(key, F.unix_micros("__w.start").alias("us"), "n", "s", "q", "hi")
    output = f"{key} {_kind(df, key)}, us bigint, n bigint, mean double, variance double, max bigint"
    return _at(run(rows, key, live.RunningMoments(key), output, time="None"), "window_start")
