"""Alert rules that change over time: versions, as-of matching, overrides, audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.registry import small_side
from tidewatch.operators.detect import sustained_breach
from tidewatch.operators.timeline import Timeline, latest, previous, total
from tidewatch.operators.windows import span_us

ANY_WARD = "*"
#: narrow copies of rule versions, a few MB, up to which the rule side carries a broadcast hint
BROADCAST_COPIES = 50_000
#: before all times, in microseconds; its negative is after all times
NEVER_US = -(2**55)
RECORD = ["ruleId", "wardId", "min", "max", "sustainSeconds", "severity", "valid_from", "valid_to", "life_end"]
RULE_FIELDS = ["wardId", "vitalCode", "min", "max", "sustainSeconds", "severity"]


def rule_audit(commands: DataFrame, order: str, ties: Sequence[str] = (), hot_rows: int | None = None) -> DataFrame:
    """One record per rule change with the bounds before it (null for a new or deleted rule)."""
    rules = commands.where(F.col("kind") == "RULE")
    line = Timeline.of(rules, ["ruleId"], order, ties, hot_rows)
    return line.scan(oldOp=previous("op"), oldMin=previous("min"), oldMax=previous("max")).frame().withColumn(
        "change",
        F.when(F.col("op") == "DELETE", "removed").when(F.col("oldOp") == "UPSERT", "changed").otherwise("added"),
    )


def versions(commands: DataFrame, keys: Sequence[str], order: str, fields: Sequence[str], ties: Sequence[str] = (), hot_rows: int | None = None) -> DataFrame:
    """Commands as versions in force over [valid_from, valid_to), and the end of the unbroken life.

    ``life_end`` is the time of the next delete of the key (null if there is none).
    """
    # the next command of a key is found by scanning its commands backwards in time
    back = commands.withColumn("__back", -F.unix_micros(F.col(order)))
    ties_back = [f"__back_{t}" for t in ties]
    back = back.withColumns({b: -F.col(t) for b, t in zip(ties_back, ties)})
    line = Timeline.of(back, keys, "__back", ties_back, hot_rows)
    deleted_at = F.when(F.col("op") == "DELETE", F.col(order))
    line = line.scan(valid_to=previous(order))
    line = line.scan(life_end=latest(deleted_at, before=True))
    done = line.frame().where(F.col("op") == "UPSERT")
    return done.select(*keys, *fields, F.col(order).alias("valid_from"), "valid_to", "life_end")


def rule_set(rules: DataFrame, defaults: DataFrame) -> DataFrame:
    """Rule versions, preceded by the default rules that hold until the first command arrives."""
    first = rules.agg(F.min("valid_from").alias("f")).first()["f"]
    until = F.lit(first).cast("timestamp")
    past = defaults.withColumns(
        {"valid_from": F.lit(None).cast("timestamp"), "valid_to": until, "life_end": until}
    )
    return rules.unionByName(past)


def match_rules(readings: DataFrame, rules: DataFrame, ts: str, bucket: str = "1 day") -> DataFrame:
    """Each reading with each rule in force for its vital and ward; ward rules override ``*`` rules.

    A rule version is copied to the time buckets it is in force in, and the versions of one
    (vital, ward, bucket) become one array.  A reading finds its arrays by two many-to-one equi-joins
    and is matched in place, so readings are never multiplied before their rules are known, equal
    readings stay apart, and an array grows with the changes inside a bucket, not with the history.
    Before the first change and after the last one nothing changes any more, so readings from there
    share the first and the last bucket.

    A reading without a time matches only versions without bounds; one without a ward matches ``*`` rules.
    """
    width = span_us(bucket)

    def slot(time: Column) -> Column:
        return F.floor(F.unix_micros(time) / F.lit(width))

    span = rules.agg(
        F.least(F.min(slot(F.col("valid_from"))), F.min(slot(F.col("valid_to")))).alias("lo"),
        F.greatest(F.max(slot(F.col("valid_from"))), F.max(slot(F.col("valid_to")))).alias("hi"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    lo, hi = F.lit(span["lo"] or 0).cast("bigint"), F.lit(span["hi"] or 0).cast("bigint")
    first, last = F.coalesce(slot(F.col("valid_from")), lo), F.coalesce(slot(F.col("valid_to")), hi)
    copies = rules.where(first <= last).withColumn("__slot", F.explode(F.sequence(first, last)))
    narrow = span["n"] * ((span["hi"] or 0) - (span["lo"] or 0) + 1) <= BROADCAST_COPIES

    def packed(side: DataFrame, on: Sequence[str], name: str) -> tuple[DataFrame, Column]:
        held = side.groupBy(*on, "__slot").agg(F.collect_list(F.struct(*RECORD)).alias(name))
        held = held.withColumnsRenamed({k: f"{name}_{k}" for k in (*on, "__slot")})
        equal = F.col("__slot") == F.col(f"{name}___slot")
        for k in on:
            equal = equal & (F.col(k) == F.col(f"{name}_{k}"))
        return (F.broadcast(held) if narrow else held), equal

    def in_force(rule: Column) -> Column:
        started = rule["valid_from"].isNull() | (rule["valid_from"] <= F.col(ts))
        return started & (rule["valid_to"].isNull() | (F.col(ts) < rule["valid_to"]))

    own, same_ward = packed(copies, ["vitalCode", "wardId"], "__own")
    general, same_vital = packed(copies.where(F.col("wardId") == ANY_WARD), ["vitalCode"], "__any")
    # greatest and least skip nulls, so a reading without a time has a bucket too
    placed = readings.withColumn("__slot", F.greatest(lo, F.least(hi, slot(F.col(ts)))))
    joined = placed.join(own, same_ward, "left").join(general, same_vital, "left")
    own_rules = F.filter(F.coalesce("__own", F.array()), in_force)
    any_rules = F.filter(F.coalesce("__any", F.array()), in_force)
    joined = joined.withColumn("__held", own_rules).withColumn(
        "__rule", F.explode(F.when(F.size("__held") > 0, F.col("__held")).otherwise(any_rules))
    )
    chosen = {f"rule_{c}": F.col(f"__rule.{c}") for c in ("min", "max", "sustainSeconds", "severity", "life_end")}
    return joined.select(*readings.columns, F.col("__rule.ruleId").alias("ruleId"), *[c.alias(n) for n, c in chosen.items()])


def match_in_order(readings: DataFrame, rules: DataFrame, ts: str, hot_rows: int | None = None) -> DataFrame:
    """The same matches as :func:`match_rules`, for bounded readings under very many versions.

    Nothing is copied or packed: changes and readings lie on one timeline.  Per vital and ward a
    running count of the ward's rules in force tells whether they override the ``*`` rules; per
    rule, the latest version at a reading is the one it meets.  So a dense hour or a long history
    costs its rows, cut along time where they are many, and a version is one row however long it
    holds.  A reading is repeated once per rule of its vital and ward (or ``*``), before it is
    known which of them are in force.
    """
    always = F.timestamp_micros(F.lit(NEVER_US))
    started = F.coalesce(F.col("valid_from"), always)
    timed = readings.where(F.col(ts).isNotNull())

    # is any rule of the reading's own ward in force?
    own = rules.where(F.col("wardId") != ANY_WARD)
    opened = own.select("vitalCode", "wardId", started.alias("__at"), F.lit(1).cast("bigint").alias("__step"))
    closed = own.where("valid_to is not null").select("vitalCode", "wardId", F.col("valid_to").alias("__at"), F.lit(-1).cast("bigint").alias("__step"))
    changes = opened.union(closed).withColumn("__turn", F.lit(0))
    met = timed.withColumns({"__at": F.col(ts), "__step": F.lit(0).cast("bigint"), "__turn": F.lit(1)})
    line = Timeline.of(met.unionByName(changes, allowMissingColumns=True), ["vitalCode", "wardId"], "__at", ["__turn"], hot_rows)
    counted = line.scan(__open=total("__step")).frame().where("__turn = 1")
    target = F.when(F.col("__open") > 0, F.col("wardId")).otherwise(F.lit(ANY_WARD))
    asked = counted.select(*readings.columns, target.alias("__ward"))

    names = rules.select(F.col("vitalCode").alias("__v"), F.col("wardId").alias("__w"), F.col("ruleId").alias("__rule")).distinct()
    spread = asked.join(small_side(names, 10_000), (F.col("vitalCode") == F.col("__v")) & (F.col("__ward") == F.col("__w"))).drop("__ward")

    last = F.coalesce(F.unix_micros("valid_to"), F.lit(-NEVER_US))
    held = rules.select(
        F.col("vitalCode").alias("__v"), F.col("wardId").alias("__w"), F.col("ruleId").alias("__rule"), started.alias("__at"), F.lit(0).alias("__turn"),
        last.alias("__tie"), F.struct("min", "max", "sustainSeconds", "severity", "valid_to", "life_end").alias("__version"),
    )
    copies = spread.withColumns({"__at": F.col(ts), "__turn": F.lit(1), "__tie": F.lit(0).cast("bigint")})
    line = Timeline.of(copies.unionByName(held, allowMissingColumns=True), ["__v", "__w", "__rule"], "__at", ["__turn", "__tie"], hot_rows)
    found = line.scan(__now=latest("__version")).frame().where("__turn = 1")
    found = found.where(F.col("__now").isNotNull() & (F.col("__now.valid_to").isNull() | (F.col(ts) < F.col("__now.valid_to"))))
    chosen = [F.col(f"__now.{c}").alias(f"rule_{c}") for c in ("min", "max", "sustainSeconds", "severity", "life_end")]
    matched = found.select(*readings.columns, F.col("__rule").alias("ruleId"), *chosen)
    return matched.unionByName(match_rules(readings.where(F.col(ts).isNull()), rules.where("valid_from is null and valid_to is null"), ts))


def outside(value: Column, low: Column, high: Column) -> Column:
    return (value < low) | (value > high)


def threshold_alerts(readings: DataFrame, rules: DataFrame, ts: str, bucket: str = "1 day", ordered: bool = False) -> DataFrame:
    """Reading x matching rule whose value is outside [min, max]; ``ordered`` for very many rule versions."""
    matched = match_in_order(readings, rules, ts) if ordered else match_rules(readings, rules, ts, bucket)
    return matched.where(outside(F.col("value"), F.col("rule_min"), F.col("rule_max")))


def with_care_plan(matched: DataFrame, plans: DataFrame, ts: str) -> DataFrame:
    """Replace a rule's bounds by the patient's care plan for that vital, where one is in force.

    Adds ``min``/``max`` in effect, ``by_plan``, and ``route``: ``alert``, ``suppressed``
    (outside the rule but inside the plan) or ``ok``.
    """
    side = plans.select(
        F.col("patientId").alias("__p"),
        F.col("vitalCode").alias("__v"),
        F.col("min").alias("__min"),
        F.col("max").alias("__max"),
        F.col("valid_from").alias("__from"),
        F.col("valid_to").alias("__to"),
    )
    holds = (
        (F.col("patientId") == F.col("__p"))
        & (F.col("vitalCode") == F.col("__v"))
        & (F.col("__from") <= F.col(ts))
        & (F.col("__to").isNull() | (F.col(ts) < F.col("__to")))
    )
    joined = matched.join(small_side(side, 10_000), holds, "left").withColumns(
        {
            "by_plan": F.col("__p").isNotNull(),
            "min": F.coalesce("__min", "rule_min"),
            "max": F.coalesce("__max", "rule_max"),
        }
    )
    breach = outside(F.col("value"), F.col("min"), F.col("max"))
    ruled = outside(F.col("value"), F.col("rule_min"), F.col("rule_max"))
    return joined.withColumn("route", F.when(breach, "alert").when(ruled, "suppressed").otherwise("ok")).drop(
        "__p", "__v", "__min", "__max", "__from", "__to"
    )


def sustained_rule_breach(
    matched: DataFrame, ts: str, until_us: int, ties: Sequence[str] = (), us_per_second: int = 1_000_000, hot_rows: int | None = None
) -> DataFrame:
    """Episodes per (patient, rule) that outlast the rule's sustain time.

    An episode belongs to one unbroken life of its rule: it does not outlive a delete, and
    a rule deleted at or before the deadline does not alert.  Where care plans were applied,
    ``by_plan`` says whether one set the bounds when the episode began.
    """
    rows = matched.withColumn("__life", F.coalesce(F.unix_micros("rule_life_end"), F.lit(-1)))
    low, high = (F.col("min"), F.col("max")) if "by_plan" in matched.columns else (F.col("rule_min"), F.col("rule_max"))
    alerts = sustained_breach(
        rows,
        ["patientId", "ruleId", "__life"],
        ts,
        outside(F.col("value"), low, high),
        F.col("rule_sustainSeconds").cast("bigint") * us_per_second,
        until_us,
        ties,
        deadline_before=F.unix_micros("rule_life_end"),
        carry=["by_plan"] if "by_plan" in matched.columns else [],
        hot_rows=hot_rows,
    )
    return alerts.drop("__life")
