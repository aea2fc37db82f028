"""Device frames and rule commands: parsing text that may be malformed, without failing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.rows import once

FRAME_VERSION = "VW1"
# Level of consciousness as a number.
CONSCIOUSNESS = {"A": 0.0, "C": 1.0, "V": 2.0, "P": 3.0, "U": 4.0}
# Physiological limits, both ends allowed.
LIMITS = {
    "HR": (20.0, 300.0),
    "SPO2": (50.0, 100.0),
    "TEMP": (25.0, 45.0),
    "RR": (1.0, 80.0),
    "SBP": (30.0, 300.0),
    "DBP": (10.0, 200.0),
    "O2": (0.0, 1.0),
    "CONSC": (0.0, 4.0),
}
LEAD_OFF_CODES = ["HR", "SPO2"]
SKEW_LIMIT_MS = 5 * 60 * 1000


def parse_frames(df: DataFrame, line: str) -> DataFrame:
    """``VW1|device|patient|ward|epoch ms|K=V;K=V`` as typed columns.

    A malformed frame keeps its row with ``valid`` false and the reason in ``parseError``.
    """
    df = once(df, "__parts", F.split(F.col(line), r"\|", -1))
    parts = F.col("__parts")

    def field(i: int) -> Column:
        return F.try_element_at(parts, F.lit(i))

    entries = F.expr(
        "transform(filter(split(__body, ';', -1), e -> e <> ''), "
        "e -> named_struct('code', substring_index(e, '=', 1), 'raw', if(contains(e, '='), substr(e, instr(e, '=') + 1), cast(null as string))))"
    )
    at = field(5).try_cast("bigint")
    error = (
        F.when(F.size(parts) != 6, F.concat(F.lit("expected 6 fields, got "), F.size(parts).cast("string")))
        .when(field(1) != FRAME_VERSION, F.concat(F.lit("unknown version "), field(1)))
        .when((field(2) == "") | (field(3) == "") | (field(4) == ""), "empty identifier")
        .when(at.isNull(), "bad timestamp")
        .when(field(6) == "", "no measurements")
    )
    parsed = df.withColumns(
        {
            "version": field(1),
            "deviceId": field(2),
            "patientId": field(3),
            "wardId": field(4),
            "timestamp": F.timestamp_millis(at),
            "__body": field(6),
            "parseError": error,
        }
    )
    parsed = parsed.withColumns({"valid": F.col("parseError").isNull(), "measurements": F.when(F.col("parseError").isNull(), entries)})
    return parsed.drop("__body", "__parts", line)


def last_entries(entries: Column | str) -> Column:
    """Measurement entries with only the last one of a repeated code."""
    entries = F.col(entries) if isinstance(entries, str) else entries
    distinct = F.size(F.array_distinct(F.transform(entries, lambda e: e["code"])))
    last_only = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["code"] == e["code"]),
    )
    return F.when(distinct == F.size(entries), entries).otherwise(last_only)


def measurement_map(entries: Column | str) -> Column:
    """Raw measurements as a map from code to text."""
    return F.map_from_entries(last_entries(entries))


def explode_frames(frames: DataFrame) -> DataFrame:
    """One reading per readable measurement in normalized units; a bad one drops only itself."""
    one = frames.where("valid").select(
        "patientId", "wardId", "deviceId", "timestamp", F.inline(last_entries("measurements")).alias("vitalCode", "raw")
    )
    read = once(one, "value", normalized(F.col("vitalCode"), F.col("raw")))
    return read.where(F.col("value").isNotNull()).drop("raw")


def normalized(code: Column, raw: Column) -> Column:
    """Value of a raw measurement: temperatures in Celsius, flags and levels as numbers, null if unreadable."""
    unit = F.right(raw, F.lit(1))
    reading = raw.try_cast("double")
    body = F.substring(raw, F.lit(1), F.length(raw) - 1).try_cast("double")
    consc = F.lit(None).cast("double")
    for letter, level in CONSCIOUSNESS.items():
        consc = F.when(raw == letter, F.lit(level)).otherwise(consc)
    temperature = F.when(unit == "F", (body - 32) * 5 / 9).when(unit == "C", body)
    number = (
        F.when(code == "TEMP", temperature)
        .when(code == "O2", F.when(raw == "Y", F.lit(1.0)).when(raw == "N", F.lit(0.0)))
        .when(code == "CONSC", consc)
        .when(code.isin(*LIMITS), reading)
    )
    return F.when(~F.isnan(number), number)


def quality_route(code: Column, value: Column, at: Column, now: Column) -> Column:
    """clean, artifact, impossible or clock-skew; a lead-off 0 is an artifact before it is impossible."""
    impossible = F.lit(False)
    for name, (low, high) in LIMITS.items():
        impossible = impossible | ((code == name) & ~value.between(low, high))
    ahead = F.unix_millis(at) - F.unix_millis(now)
    return (
        F.when(ahead > SKEW_LIMIT_MS, "clock-skew")
        .when(code.isin(*LEAD_OFF_CODES) & (value == 0), "artifact")
        .when(impossible, "impossible")
        .otherwise("clean")
    )


def quality_gate(readings: DataFrame, now: Column | None = None) -> DataFrame:
    """Every reading with its route; clock-skewed ones also say by how many milliseconds."""
    now = F.current_timestamp() if now is None else now
    routed = readings.withColumn("route", quality_route(F.col("vitalCode"), F.col("value"), F.col("timestamp"), now))
    skew = F.unix_millis(F.col("timestamp")) - F.unix_millis(now)
    return routed.withColumn("skewMillis", F.when(F.col("route") == "clock-skew", skew))


def parse_rules(df: DataFrame, line: str) -> DataFrame:
    """RULE|UPSERT, RULE|DELETE, CAREPLAN|UPSERT and CAREPLAN|DELETE lines; anything else gives no row."""
    df = once(df, "__parts", F.split(F.col(line), r"\|", -1))
    parts = F.col("__parts")

    def field(i: int) -> Column:
        return F.try_element_at(parts, F.lit(i))

    kind, op, n = field(1), field(2), F.size(parts)
    rule, plan = kind == "RULE", kind == "CAREPLAN"
    upsert, delete = op == "UPSERT", op == "DELETE"
    parsed = df.withColumns(
        {
            "kind": kind,
            "op": op,
            "ruleId": F.when(rule, field(3)),
            "wardId": F.when(rule & upsert, field(4)),
            "vitalCode": F.when(rule & upsert, field(5)).when(plan, field(4)),
            "patientId": F.when(plan, field(3)),
            "min": F.when(upsert, F.when(rule, field(6)).otherwise(field(5)).try_cast("double")),
            "max": F.when(upsert, F.when(rule, field(7)).otherwise(field(6)).try_cast("double")),
            "sustainSeconds": F.when(rule & upsert, field(8).try_cast("int")),
            "severity": F.when(rule & upsert, field(9)),
        }
    )
    bounds = F.col("min").isNotNull() & F.col("max").isNotNull()
    good = (
        (rule & upsert & (n == 9) & bounds & F.col("sustainSeconds").isNotNull() & (F.col("ruleId") != ""))
        | (rule & delete & (n == 3) & (F.col("ruleId") != ""))
        | (plan & upsert & (n == 6) & bounds)
        | (plan & delete & (n == 4))
    )
    return parsed.where(good).drop("__parts", line)
