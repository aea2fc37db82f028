"""Keyed state: counts, alerts, occupancy, silence, breaches, scores, rules and paging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import frames, news2, render
from tidewatch.operators import detect, occupancy, paging, rules, running, vitals

from tidewatch.operators.timeline import Sample
from tidewatch.plans import inputs
from tidewatch.plans.catalog import query
from tidewatch.plans.inputs import ADM, EV, STAYED
from tidewatch.plans.row_queries import RULES, rule_commands
from tidewatch.sources.tables import read_table

ROWS_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
ROWS_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
HOUR_US = 3_600_000_000

# ---- counts and one-shot alerts ----


@query(
    "running_count",
    f"""WITH {ADM} SELECT event_id, hospital, row_number() OVER (PARTITION BY hospital ORDER BY ts, event_id) AS occupied FROM adm""",
)
def running_count(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.admissions(spark, folder).select("event_id", "ts", "hospital")
    measure = inputs.admission_sample(spark, folder)
    return running.running_count(rows, ["hospital"], "ts", ["event_id"], "occupied", measure=measure).drop("ts")


ALERTED = f"""{ADM}, counted AS (SELECT *, row_number() OVER (PARTITION BY hospital ORDER BY ts, event_id) AS occupied FROM adm WHERE capacity > 0),
  alerts AS (SELECT hospital, region, event_id, ts, CAST(occupied AS INTEGER) AS occupied, capacity, occupied::DOUBLE / capacity * 100.0 AS occupancy_pct FROM counted
    WHERE occupied::DOUBLE / capacity >= 0.9 QUALIFY row_number() OVER (PARTITION BY hospital ORDER BY occupied) = 1)"""


def capacity_alert_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.admissions(spark, folder)
    largest = max(inputs.CAPACITY.values())
    alerts = occupancy.capacity_alerts(rows, "hospital", "ts", "capacity", ["event_id"], max_capacity=largest)
    return alerts.select("hospital", "region", "event_id", "ts", "occupied", "capacity", "occupancy_pct")


@query("capacity_alert", f"WITH {ALERTED} SELECT * FROM alerts")
def capacity_alert(spark: SparkSession, folder: str) -> DataFrame:
    return capacity_alert_rows(spark, folder)


@query(
    "passthrough_tagged",
    f"""WITH {ALERTED} SELECT 'main' AS tag, event_id, hospital, CAST(NULL AS INTEGER) AS occupied FROM adm
    UNION ALL SELECT 'alert', event_id, hospital, occupied FROM alerts""",
)
def passthrough_tagged(spark: SparkSession, folder: str) -> DataFrame:
    """Every admission unchanged, plus the alerts on the side."""
    rows = inputs.admissions(spark, folder).select("event_id", "hospital")
    alerts = capacity_alert_rows(spark, folder).select("event_id", "hospital", "occupied")
    return occupancy.pass_through(rows, alerts)


@query(
    "render_alerts",
    f"""WITH {ALERTED} SELECT hospital, printf('[%s] ALERT: Hospital %s (Region %s) at %d/%d beds (%.1f%% capacity)',
      strftime(ts, '%H:%M:%S'), hospital, region, occupied, capacity, floor(occupancy_pct * 10 + 0.5) / 10.0::DOUBLE) AS line FROM alerts""",
)
def render_alerts(spark: SparkSession, folder: str) -> DataFrame:
    line = render.capacity_line("ts", "hospital", "region", "occupied", "capacity", "occupancy_pct")
    return capacity_alert_rows(spark, folder).select("hospital", line.alias("line"))


# ---- deferred emission ----


def discharges(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> DataFrame:
    rows = inputs.admissions(spark, folder) if rows is None else rows
    until = inputs.watermark(inputs.events(spark, folder))
    return occupancy.deferred_emit(rows, "ts", inputs.stay_ms(), until)


@query(
    "deferred_emit",
    f"""WITH {STAYED} SELECT event_id, hospital, ts, make_timestamp(due_us) AS due_time FROM stayed WHERE due_us <= (SELECT us FROM mark)""",
)
def deferred_emit(spark: SparkSession, folder: str) -> DataFrame:
    return discharges(spark, folder).select("event_id", "hospital", "ts", "due_time")


@query(
    "deferred_emit_multi",
    f"""WITH {EV}, d AS (SELECT user_id, event_id, ts, epoch_us(ts) + (1 + cents % 72) * {HOUR_US} AS due FROM ev)
    SELECT user_id, event_id, ts, make_timestamp(due) AS due_time FROM d WHERE due <= (SELECT max(epoch_us(ts)) - 1000 FROM events)""",
)
def deferred_emit_multi(spark: SparkSession, folder: str) -> DataFrame:
    """Keys come back before their record is out: every pending record is still emitted."""
    rows = inputs.events(spark, folder)
    wait = (1 + F.col("cents") % 72) * 3_600_000
    done = occupancy.deferred_emit(rows, "ts", wait, inputs.watermark(rows))
    return done.select("user_id", "event_id", "ts", "due_time")


@query(
    "deferred_emit_single",
    f"""WITH {EV}, d AS (SELECT user_id, event_id, epoch_us(ts) AS us, epoch_us(ts) + (1 + cents % 72) * {HOUR_US} AS due FROM ev),
      fires AS (SELECT user_id, due AS at_us FROM d WHERE due <= (SELECT max(epoch_us(ts)) - 1000 FROM events)),
      slot AS (SELECT f.user_id, f.at_us, (SELECT max(us) FROM d WHERE d.user_id = f.user_id AND d.us <= f.at_us) AS held_us,
        (SELECT max(at_us) FROM fires g WHERE g.user_id = f.user_id AND g.at_us < f.at_us) AS emptied_us FROM fires f)
    SELECT DISTINCT s.user_id, d.event_id, make_timestamp(d.due) AS due_time, make_timestamp(s.at_us) AS emitted_at
    FROM slot s JOIN d ON d.user_id = s.user_id AND d.us = s.held_us WHERE emptied_us IS NULL OR held_us > emptied_us""",
)
def deferred_emit_single(spark: SparkSession, folder: str) -> DataFrame:
    """One pending slot per key: a later arrival overwrites it and goes out on the earlier timer."""
    rows = inputs.events(spark, folder).select("user_id", "event_id", "ts", "cents")
    wait = (1 + F.col("cents") % 72) * 3_600_000
    done = occupancy.deferred_emit_single(rows, ["user_id"], "ts", wait, ["event_id"], inputs.watermark(rows))
    return done.select("user_id", "event_id", "due_time", "emitted_at")


# ---- occupancy ----

STEPS = f"""{STAYED}, steps AS (SELECT hospital, region, capacity, event_id, epoch_us(ts) AS us, 1 AS delta FROM stayed WHERE capacity > 0
    UNION ALL SELECT hospital, region, capacity, event_id, due_us, -1 FROM stayed WHERE capacity > 0 AND due_us <= (SELECT us FROM mark))"""

ALL_STEPS = f"""{STAYED}, steps AS (SELECT hospital, event_id, epoch_us(ts) AS us, 1 AS delta FROM stayed
    UNION ALL SELECT hospital, event_id, due_us, -1 FROM stayed WHERE due_us <= (SELECT us FROM mark))"""

CLAMPED = """run AS (SELECT *, sum(delta) OVER (PARTITION BY {key} ORDER BY us, -delta, event_id {so_far}) AS s FROM steps),
  low AS (SELECT *, min(s) OVER (PARTITION BY {key} ORDER BY us, -delta, event_id {so_far}) AS m,
    min(s) OVER (PARTITION BY {key} ORDER BY us, -delta, event_id {before}) AS mb FROM run),
  occ AS (SELECT *, (s - least(0, m))::BIGINT AS occupied, s < least(0, coalesce(mb, 0)) AS underflow FROM low)"""


def clamped_sql(key: str) -> str:
    return CLAMPED.format(key=key, so_far=ROWS_SO_FAR, before=ROWS_BEFORE)


LATCHED = f"""latch AS (SELECT *,
    last_value(CASE WHEN ratio >= 0.90 THEN 1 WHEN ratio < 0.85 THEN 0 END IGNORE NULLS) OVER w AS high,
    last_value(CASE WHEN ratio >= 1.00 THEN 1 WHEN ratio < 0.95 THEN 0 END IGNORE NULLS) OVER w AS full_
    FROM rated WINDOW w AS (PARTITION BY hospital ORDER BY us, ord, event_id {ROWS_SO_FAR})),
  named AS (SELECT *, CASE WHEN full_ = 1 THEN 'FULL' WHEN high = 1 THEN 'HIGH' ELSE 'NORMAL' END AS status FROM latch),
  moved AS (SELECT *, coalesce(lag(status) OVER (PARTITION BY hospital ORDER BY us, ord, event_id), 'NORMAL') AS previous_status FROM named)"""

STATUS = f"""{STEPS}, {clamped_sql('hospital')}, rated AS (SELECT *, -delta AS ord, occupied::DOUBLE / capacity AS ratio FROM occ), {LATCHED},
  changes AS (SELECT hospital, region, event_id, make_timestamp(us) AS ts, previous_status, status, occupied, capacity, ratio * 100.0::DOUBLE AS occupancy_pct
    FROM moved WHERE status <> previous_status)"""


def bed_steps(rows: DataFrame, until: int) -> DataFrame:
    return occupancy.stay_steps(rows, ["hospital", "region", "capacity", "event_id"], "ts", inputs.stay_ms(), until)


def bed_line(spark: SparkSession, folder: str) -> dict:
    """Steps of all known hospitals and what to count them on, as arguments of the occupancy operators."""
    until = inputs.watermark(inputs.events(spark, folder))
    part = inputs.admission_sample(spark, folder)
    measure = Sample(bed_steps(part.rows, until), part.weight)
    return {
        "deltas": bed_steps(inputs.admissions(spark, folder), until), "key": "hospital", "ts": "ts", "delta": "delta", "capacity": "capacity",
        "ties": ["event_id"], "measure": measure,
    }


@query(
    "occupancy",
    f"WITH {STEPS}, {clamped_sql('hospital')} SELECT hospital, event_id, make_timestamp(us) AS ts, delta, occupied, underflow FROM occ",
)
def occupancy_levels(spark: SparkSession, folder: str) -> DataFrame:
    line = occupancy.occupancy(**bed_line(spark, folder))
    return line.frame().select("hospital", "event_id", "ts", "delta", "occupied", "underflow")


FLOOR_STEPS = f"""{EV}, steps AS (SELECT user_id, event_id, epoch_us(ts) AS us, CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE -1 END AS delta FROM ev)"""


@query(
    "occupancy_floor",
    f"WITH {FLOOR_STEPS}, {clamped_sql('user_id')} SELECT user_id, event_id, occupied, underflow FROM occ",
)
def occupancy_floor(spark: SparkSession, folder: str) -> DataFrame:
    """More steps down than up, so the floor at 0 is hit often."""
    up = F.col("event_type").isin("view", "click")
    steps = inputs.events(spark, folder).select(
        "user_id", "event_id", "ts", F.when(up, 1).otherwise(-1).alias("delta"), F.lit(10).alias("capacity")
    )
    line = occupancy.occupancy(steps, "user_id", "ts", "delta", "capacity", ["event_id"])
    return line.frame().select("user_id", "event_id", "occupied", "underflow")


def bed_status_changes(spark: SparkSession, folder: str) -> DataFrame:
    return occupancy.occupancy_alerts(**bed_line(spark, folder))


@query("occupancy_alerts", f"WITH {STATUS} SELECT * FROM changes")
def occupancy_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return bed_status_changes(spark, folder)


@query(
    "render_status",
    f"""WITH {STATUS} SELECT event_id, printf('[%s] %s -> %s: Hospital %s (Region %s) at %d/%d beds (%.1f%% occupancy)', strftime(ts, '%H:%M:%S'),
      previous_status, status, hospital, region, occupied, capacity, floor(occupancy_pct * 10 + 0.5) / 10.0::DOUBLE) AS line FROM changes""",
)
def render_status(spark: SparkSession, folder: str) -> DataFrame:
    line = render.occupancy_line(
        "ts", "previous_status", "status", "hospital", "region", "occupied", "capacity", "occupancy_pct"
    )
    return bed_status_changes(spark, folder).select("event_id", line.alias("line"))


RESIZED = f"""{ALL_STEPS}, sized AS (SELECT o_orderkey AS event_id, hospital, us, size FROM (SELECT o_orderkey, n_name AS hospital,
        epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1995-01-01') AS off_us, CAST(60 + o_orderkey % 60 AS INTEGER) AS size
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
        CROSS JOIN (SELECT epoch_us(TIMESTAMP '2024-01-01') AS base) CROSS JOIN LATERAL (SELECT base + off_us // 80 AS us)),
      tl AS (SELECT hospital, event_id, us, delta, NULL::INTEGER AS size, CASE WHEN delta > 0 THEN 1 ELSE 2 END AS ord FROM steps
        UNION ALL SELECT hospital, event_id, us, 0, size, 0 FROM sized),
      cap AS (SELECT *, last_value(size IGNORE NULLS) OVER (PARTITION BY hospital ORDER BY us, ord, event_id {ROWS_SO_FAR}) AS capacity FROM tl),
      run AS (SELECT *, sum(CASE WHEN capacity > 0 THEN delta ELSE 0 END) OVER (PARTITION BY hospital ORDER BY us, ord, event_id {ROWS_SO_FAR}) AS s FROM cap),
      low AS (SELECT *, min(s) OVER (PARTITION BY hospital ORDER BY us, ord, event_id {ROWS_SO_FAR}) AS m FROM run),
      rated AS (SELECT *, (s - least(0, m))::BIGINT AS occupied, (s - least(0, m))::DOUBLE / capacity AS ratio FROM low), {LATCHED}"""


def capacity_updates(spark: SparkSession, folder: str, orders: DataFrame) -> DataFrame:
    """Orders (bounded or a stream) as new capacities of the hospitals of their customers."""
    customer = read_table(spark, folder, "customer", "c_custkey", "c_nationkey")
    nation = F.broadcast(read_table(spark, folder, "nation", "n_nationkey", "n_name"))
    off = F.unix_micros(F.col("o_orderdate").cast("timestamp")) - F.unix_micros(F.lit("1995-01-01").cast("timestamp"))
    base = F.unix_micros(F.lit("2024-01-01").cast("timestamp"))
    timed = orders.withColumn("__off", off).withColumn("ts", F.timestamp_micros(base + F.expr("__off div 80")))
    if timed.isStreaming:
        timed = timed.withWatermark("ts", "1 millisecond")
    rows = timed.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    size = (60 + F.col("o_orderkey") % 60).cast("int")
    return rows.select(F.col("n_name").alias("hospital"), "ts", size.alias("capacity"), F.col("o_orderkey").alias("event_id"))


@query(
    "dynamic_capacity",
    f"WITH {RESIZED} SELECT hospital, event_id, make_timestamp(us) AS ts, previous_status, status, occupied, capacity FROM moved WHERE status <> previous_status",
)
def dynamic_capacity(spark: SparkSession, folder: str) -> DataFrame:
    """Capacity updates, taken from the orders of a nation's customers, re-evaluate its status at once."""
    updates = capacity_updates(spark, folder, read_table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderdate"))
    steps = bed_steps(inputs.admissions(spark, folder), inputs.watermark(inputs.events(spark, folder))).drop("region")
    changes = occupancy.dynamic_capacity(steps, updates, "hospital", "ts", "delta", "capacity", ["event_id"])
    return changes.select("hospital", "event_id", "ts", "previous_status", "status", "occupied", "capacity")


@query(
    "littles_law",
    f"""WITH {STAYED}, steps AS (SELECT region, event_id, epoch_us(ts) AS us, 1 AS delta, stay_ms FROM stayed WHERE region IS NOT NULL
        UNION ALL SELECT region, event_id, due_us, -1, NULL FROM stayed WHERE region IS NOT NULL AND due_us <= (SELECT us FROM mark)),
      lv AS (SELECT *, coalesce(sum(delta) OVER (PARTITION BY region ORDER BY us, -delta, event_id {ROWS_BEFORE}), 0)::BIGINT AS level,
        us - lag(us) OVER (PARTITION BY region ORDER BY us, -delta, event_id) AS step FROM steps),
      a AS (SELECT region, sum(level::HUGEINT * coalesce(step, 0)) AS area_us, max(us) - min(us) AS span_us, count(*) FILTER (delta > 0) AS arrivals,
        sum(stay_ms) AS stays FROM lv GROUP BY region)
    SELECT region, arrivals, area_us::DOUBLE / span_us AS mean_occupancy, arrivals::DOUBLE / span_us * (stays::DOUBLE / arrivals * 1000) AS predicted FROM a""",
)
def littles_law(spark: SparkSession, folder: str) -> DataFrame:
    """Measured mean occupancy per region next to arrival rate x mean stay."""
    rows = inputs.admissions(spark, folder).where(F.col("region").isNotNull())
    until = inputs.watermark(inputs.events(spark, folder))
    part = inputs.admission_sample(spark, folder)

    def steps(admitted: DataFrame) -> DataFrame:
        # the stay goes along with the step up, so nothing is joined back
        return occupancy.stay_steps(admitted.withColumn("stay", inputs.stay_ms()), ["region", "event_id", "stay"], "ts", F.col("stay"), until)

    measure = Sample(steps(part.rows), part.weight)
    stays = F.sum(F.when(F.col("delta") > 0, F.col("stay")))
    both = occupancy.littles_law(steps(rows), "region", "ts", "delta", ["event_id"], measure=measure, aggs={"stays": stays})
    rate = F.col("arrivals").cast("double") / F.col("span_us")
    return both.select(
        "region",
        "arrivals",
        (F.col("area_us").cast("double") / F.col("span_us")).alias("mean_occupancy"),
        (rate * (F.col("stays").cast("double") / F.col("arrivals") * 1000)).alias("predicted"),
    )


@query(
    "metrics_counts",
    f"""WITH {STEPS}, {clamped_sql('hospital')} SELECT count(*) FILTER (delta > 0) AS readings_processed, count(*) FILTER (delta < 0) AS discharges_emitted,
      count(*) FILTER (underflow) AS occupancy_underflows FROM occ""",
)
def metrics_counts(spark: SparkSession, folder: str) -> DataFrame:
    line = occupancy.occupancy(**bed_line(spark, folder))
    return line.frame().agg(
        F.count_if(F.col("delta") > 0).alias("readings_processed"),
        F.count_if(F.col("delta") < 0).alias("discharges_emitted"),
        F.count_if("underflow").alias("occupancy_underflows"),
    )


# ---- silence and breaches ----


@query(
    "silence_resume",
    f"""WITH n AS (SELECT user_id, epoch_us(ts) AS us, lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM events),
      m AS (SELECT max(epoch_us(ts)) - 1000 AS us FROM events)
    SELECT user_id, 'SILENT' AS alert, make_timestamp(us + {12 * HOUR_US}) AS alert_time FROM n
      WHERE nx - us > {12 * HOUR_US} OR (nx IS NULL AND us + {12 * HOUR_US} <= (SELECT us FROM m))
    UNION ALL SELECT user_id, 'RESUMED', make_timestamp(nx) FROM n WHERE nx - us > {12 * HOUR_US}""",
)
def silence_resume(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.events(spark, folder)
    return detect.silence_resume(rows, ["user_id"], "ts", "12 hours", inputs.watermark(rows), ["event_id"])


@query(
    "sustained_breach",
    f"""WITH f AS (SELECT user_id, epoch_us(ts) AS us, event_id, value > 30 AS hot, sum(CASE WHEN value > 30 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id {ROWS_SO_FAR}) AS g FROM events),
      e AS (SELECT user_id, g, min(us) FILTER (hot) AS start_us FROM f GROUP BY ALL),
      x AS (SELECT e.user_id, start_us, (SELECT min(us) FROM f WHERE f.user_id = e.user_id AND f.g = e.g + 1 AND NOT hot) AS end_us FROM e WHERE start_us IS NOT NULL)
    SELECT user_id, make_timestamp(start_us) AS breach_start, make_timestamp(start_us + {6 * HOUR_US}) AS alert_time FROM x
    WHERE (end_us IS NULL OR end_us >= start_us + {6 * HOUR_US}) AND start_us + {6 * HOUR_US} <= (SELECT max(epoch_us(ts)) - 1000 FROM events)""",
)
def sustained_breach(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.events(spark, folder)
    return detect.sustained_breach(
        rows, ["user_id"], "ts", F.col("value") > 30, 6 * HOUR_US, inputs.watermark(rows), ["event_id"]
    )


@query("per_key_threshold", "SELECT event_id, user_id, value FROM events WHERE event_type = 'view' AND value > 74")
def per_key_threshold(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.events(spark, folder)
    return rows.where((F.col("event_type") == "view") & (F.col("value") > 74)).select("event_id", "user_id", "value")


@query(
    "login_attempts",
    f"""SELECT * FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempts FROM events WHERE event_type = 'signup') WHERE attempts > 10""",
)
def login_attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts so far per address, reported from the eleventh on."""
    logins = inputs.events(spark, folder).where("event_type = 'signup'").select("event_id", "ts", "user_id")
    counted = running.running_count(logins, ["user_id"], "ts", ["event_id"], "attempts")
    return counted.where(F.col("attempts") > 10).drop("ts")


@query(
    "lifecycle_flags",
    """SELECT conv_id, bool_or(role = 'system') AS created, bool_or(role = 'user') AS paid, bool_or(role = 'assistant') AS shipped FROM conversations GROUP BY ALL""",
)
def lifecycle_flags(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "conversations", "conv_id", "role")
    return rows.groupBy("conv_id").agg(
        F.bool_or(F.col("role") == "system").alias("created"),
        F.bool_or(F.col("role") == "user").alias("paid"),
        F.bool_or(F.col("role") == "assistant").alias("shipped"),
    )


@query(
    "latest_status",
    """SELECT user_id, CASE arg_max(event_type, (ts, event_id)) WHEN 'signup' THEN 'WORKING' WHEN 'view' THEN 'WORKING' WHEN 'click' THEN 'ON_BREAK' ELSE 'OFF_WORK' END AS status,
      max(ts) AS since FROM events GROUP BY ALL""",
)
def latest_status(spark: SparkSession, folder: str) -> DataFrame:
    last = inputs.events(spark, folder).groupBy("user_id").agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("last"), F.max("ts").alias("since")
    )
    status = F.when(F.col("last").isin("signup", "view"), "WORKING").when(F.col("last") == "click", "ON_BREAK")
    return last.select("user_id", status.otherwise("OFF_WORK").alias("status"), "since")


# ---- early-warning scores ----

CODES = ["RR", "SPO2", "O2", "SBP", "HR", "CONSC", "TEMP"]
VITAL_CODE = "CASE event_id % 7 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CODES)) + " END"
VITAL_VALUE = """CAST(CASE event_id % 7 WHEN 0 THEN 6 + cents % 22 WHEN 1 THEN 88 + cents % 13 WHEN 2 THEN cents % 2 WHEN 3 THEN 80 + cents % 150
  WHEN 4 THEN 35 + cents % 110 WHEN 5 THEN cents % 5 ELSE (340 + cents % 60) / 10.0 END AS DOUBLE)"""
VITALS = f"{EV}, vit AS (SELECT event_id, user_id, ts, epoch_us(ts) AS us, {VITAL_CODE} AS code, {VITAL_VALUE} AS v FROM ev)"

_BANDS = {
    "RR": "v <= 8 THEN 3 WHEN v <= 11 THEN 1 WHEN v <= 20 THEN 0 WHEN v <= 24 THEN 2 ELSE 3",
    "SPO2": "v <= 91 THEN 3 WHEN v <= 93 THEN 2 WHEN v <= 95 THEN 1 ELSE 0",
    "O2": "v > 0 THEN 2 ELSE 0",
    "SBP": "v <= 90 THEN 3 WHEN v <= 100 THEN 2 WHEN v <= 110 THEN 1 WHEN v <= 219 THEN 0 ELSE 3",
    "HR": "v <= 40 THEN 3 WHEN v <= 50 THEN 1 WHEN v <= 90 THEN 0 WHEN v <= 110 THEN 1 WHEN v <= 130 THEN 2 ELSE 3",
    "CONSC": "v > 0 THEN 3 ELSE 0",
    "TEMP": "v <= 35.0 THEN 3 WHEN v <= 36.0 THEN 1 WHEN v <= 38.0 THEN 0 WHEN v <= 39.0 THEN 1 ELSE 2",
}
_POINTS = "CASE code " + " ".join(f"WHEN '{c}' THEN (CASE WHEN {_BANDS[c]} END)" for c in CODES) + " END"
_FRESH_US = 5 * 24 * HOUR_US
_LATEST = ", ".join(
    f"last_value(CASE WHEN code = '{c}' THEN us END IGNORE NULLS) OVER w AS us{i}, last_value(CASE WHEN code = '{c}' THEN p END IGNORE NULLS) OVER w AS p{i}"
    for i, c in enumerate(CODES)
)
SCORED = f"""{VITALS}, pts AS (SELECT *, {_POINTS} AS p FROM vit),
  seen AS (SELECT event_id, user_id, ts, us, {_LATEST} FROM pts WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id {ROWS_SO_FAR})),
  gaps AS (SELECT *, concat_ws(',', {", ".join(f"CASE WHEN coalesce(us - us{i} <= {_FRESH_US}, false) THEN NULL ELSE '{c}' END" for i, c in enumerate(CODES))}) AS missing FROM seen)"""
_FRESH_FOR = "5 days"


def vital_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Events as vital-sign readings of one of the seven signs."""
    rows = inputs.events(spark, folder)
    return rows.select("event_id", "user_id", "ts", F.expr(VITAL_CODE).alias("code"), F.expr(VITAL_VALUE).alias("v"))


@query("news2_points", f"WITH {VITALS} SELECT event_id, code, v, {_POINTS} AS points FROM vit")
def news2_points(spark: SparkSession, folder: str) -> DataFrame:
    points = news2.points_by_code(F.col("code"), F.col("v"))
    return vital_readings(spark, folder).select("event_id", "code", "v", points.alias("points"))


@query(
    "news2_score",
    f"""WITH {SCORED}, t AS (SELECT *, {" + ".join(f"p{i}" for i in range(7))} AS total, greatest({", ".join(f"p{i}" for i in range(7))}) AS top FROM gaps WHERE missing = ''),
      b AS (SELECT *, CASE WHEN total >= 7 THEN 'HIGH' WHEN total >= 5 THEN 'MEDIUM' WHEN top = 3 THEN 'LOW-MEDIUM' ELSE 'LOW' END AS band FROM t),
      c AS (SELECT *, lag(total) OVER w AS pt, lag(band) OVER w AS pb FROM b WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, user_id, ts, total, band, {", ".join(f"p{i} AS {c.lower()}_points" for i, c in enumerate(CODES))} FROM c WHERE pt IS NULL OR pt <> total OR pb <> band""",
)
def news2_score(spark: SparkSession, folder: str) -> DataFrame:
    changes = vitals.news2_changes(vital_readings(spark, folder), "user_id", "ts", "code", "v", ["event_id"], _FRESH_FOR)
    return changes.select("event_id", "user_id", "ts", "total", "band", *[f"{code.lower()}_points" for code in CODES])


def greedy_sql(source: str, key: str, step_us: int) -> str:
    """Walk per key from a kept row to the first one at least ``step_us`` later."""
    return f"""nxt AS (SELECT DISTINCT {key}, us, min(us) OVER (PARTITION BY {key} ORDER BY us
      RANGE BETWEEN {step_us} FOLLOWING AND UNBOUNDED FOLLOWING) AS nu FROM {source}),
    kept AS (SELECT {key}, min(us) AS us FROM {source} GROUP BY ALL
      UNION ALL SELECT n.{key}, n.nu FROM kept k JOIN nxt n ON n.{key} = k.{key} AND n.us = k.us WHERE n.nu IS NOT NULL)"""


@query(
    "news2_unavailable",
    f"""WITH RECURSIVE {SCORED}, miss AS (SELECT user_id, us, ts, event_id, missing FROM gaps WHERE missing <> ''), {greedy_sql("miss", "user_id", 24 * HOUR_US)}
    SELECT m.user_id, m.ts, m.event_id, m.missing FROM miss m JOIN kept k ON k.user_id = m.user_id AND k.us = m.us""",
)
def news2_unavailable(spark: SparkSession, folder: str) -> DataFrame:
    """Which signs are missing or stale, at most one notice per patient and day."""
    return vitals.news2_unavailable(
        vital_readings(spark, folder), "user_id", "ts", "code", "v", ["event_id"], _FRESH_FOR, "1 day"
    )


# ---- rules ----

RULE_SCRIPT = [
    ("2024-01-04 00:00:00", "RULE|UPSERT|R-CLICK|*|click|0|120|3600|HIGH"),
    ("2024-01-06 00:00:00", "RULE|UPSERT|R-VIEW|*|view|2|100|7200|LOW"),
    ("2024-01-10 00:00:00", "RULE|UPSERT|R-CLICK|*|click|0|60|3600|HIGH"),
    ("2024-01-14 00:00:00", "RULE|UPSERT|R-VIEW-B|ICU-B|view|5|60|7200|MEDIUM"),
    ("2024-01-15 00:00:00", "CAREPLAN|UPSERT|P-2|click|0|200"),
    ("2024-01-16 00:00:00", "CAREPLAN|UPSERT|P-3|view|0|90"),
    ("2024-01-18 00:00:00", "RULE|UPSERT|R-BUY|ICU-A|purchase|1|50|10800|LOW"),
    ("2024-01-22 00:00:00", "CAREPLAN|DELETE|P-3|view"),
    ("2024-01-24 00:00:00", "RULE|DELETE|R-CLICK"),
    ("2024-01-26 00:00:00", "RULE|DELETE"),
]
DEFAULT_RULES = [("DEFAULT-CLICK", "*", "click", 0.0, 150.0, 3600, "LOW")]


def rule_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The clinicians' rule script (a handful of lines; the readings grow, the rules do not)."""
    lines = spark.createDataFrame(RULE_SCRIPT, "at string, line string")
    return frames.parse_rules(lines.withColumn("ts", F.col("at").cast("timestamp")).drop("at"), "line")


def rules_in_force(spark: SparkSession, folder: str) -> DataFrame:
    commands = rule_feed(spark, folder).where("kind = 'RULE'")
    defaults = spark.createDataFrame(
        DEFAULT_RULES, "ruleId string, wardId string, vitalCode string, min double, max double, sustainSeconds int, severity string"
    )
    return rules.rule_set(rules.versions(commands, ["ruleId"], "ts", rules.RULE_FIELDS), defaults)


def care_plans(spark: SparkSession, folder: str) -> DataFrame:
    commands = rule_feed(spark, folder).where("kind = 'CAREPLAN'")
    return rules.versions(commands, ["patientId", "vitalCode"], "ts", ["min", "max"])


def ward_readings(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> DataFrame:
    ward = F.when(F.col("user_id") % 2 == 0, "ICU-A").otherwise("ICU-B")
    patient = F.concat(F.lit("P-"), F.col("user_id").cast("string"))
    rows = inputs.events(spark, folder) if rows is None else rows
    return rows.select(
        "event_id", "ts", patient.alias("patientId"), ward.alias("wardId"), F.col("event_type").alias("vitalCode"), "value"
    )


_SCRIPT = ", ".join(f"(TIMESTAMP '{at}', '{line}')" for at, line in RULE_SCRIPT)
RULED = f"""script AS (SELECT ts, string_split(line, '|') AS f FROM (VALUES {_SCRIPT}) v(ts, line)),
  rc AS (SELECT ts, f[2] AS op, f[3] AS rule_id, f[4] AS ward, f[5] AS vital, try_cast(f[6] AS DOUBLE) AS lo, try_cast(f[7] AS DOUBLE) AS hi,
    try_cast(f[8] AS INTEGER) AS sustain FROM script WHERE f[1] = 'RULE' AND len(f) >= 3),
  rv AS (SELECT rule_id, ward, vital, lo, hi, sustain, ts AS vf, op, lead(ts) OVER (PARTITION BY rule_id ORDER BY ts) AS vt,
    (SELECT min(d.ts) FROM rc d WHERE d.rule_id = rc.rule_id AND d.op = 'DELETE' AND d.ts > rc.ts) AS life_end FROM rc),
  rs AS (SELECT rule_id, ward, vital, lo, hi, sustain, vf, vt, life_end FROM rv WHERE op = 'UPSERT'
    UNION ALL SELECT 'DEFAULT-CLICK', '*', 'click', 0, 150, 3600, TIMESTAMP '1970-01-01', (SELECT min(ts) FROM rc), (SELECT min(ts) FROM rc)),
  rd AS (SELECT event_id, ts, concat('P-', user_id) AS patient, CASE WHEN user_id % 2 = 0 THEN 'ICU-A' ELSE 'ICU-B' END AS ward, event_type AS vital, value FROM events),
  cand AS (SELECT rd.*, rule_id, rs.ward AS rule_ward, lo, hi, sustain, life_end FROM rd JOIN rs ON rs.vital = rd.vital AND rs.ward IN ('*', rd.ward) AND rs.vf <= rd.ts AND (rs.vt IS NULL OR rd.ts < rs.vt)),
  matched AS (SELECT * FROM cand c WHERE rule_ward <> '*' OR NOT EXISTS (SELECT 1 FROM cand d WHERE d.event_id = c.event_id AND d.rule_ward <> '*'))"""
PLANNED = f"""{RULED}, pc AS (SELECT ts, f[2] AS op, f[3] AS patient, f[4] AS vital, try_cast(f[5] AS DOUBLE) AS plo, try_cast(f[6] AS DOUBLE) AS phi FROM script WHERE f[1] = 'CAREPLAN'),
  pv AS (SELECT *, lead(ts) OVER (PARTITION BY patient, vital ORDER BY ts) AS vt FROM pc),
  planned AS (SELECT m.*, pv.patient IS NOT NULL AS by_plan, coalesce(plo, lo) AS elo, coalesce(phi, hi) AS ehi FROM matched m
    LEFT JOIN pv ON pv.op = 'UPSERT' AND pv.patient = m.patient AND pv.vital = m.vital AND pv.ts <= m.ts AND (pv.vt IS NULL OR m.ts < pv.vt))"""


@query(
    "threshold_alerts",
    f'WITH {RULED} SELECT event_id, patient AS "patientId", rule_id AS "ruleId", value FROM matched WHERE value < lo OR value > hi',
)
def threshold_alerts(spark: SparkSession, folder: str) -> DataFrame:
    alerts = rules.threshold_alerts(ward_readings(spark, folder), rules_in_force(spark, folder), "ts")
    return alerts.select("event_id", "patientId", "ruleId", "value")


def changing_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rule versions that grow with the readings: every event sets or deletes one of eight rules of its type."""
    eighth = F.col("user_id") % 8
    commands = inputs.events(spark, folder).select(
        F.concat_ws("-", "event_type", eighth.cast("string")).alias("ruleId"),
        F.when(eighth % 3 == 0, rules.ANY_WARD).when(eighth % 3 == 1, "ICU-A").otherwise("ICU-B").alias("wardId"),
        F.col("event_type").alias("vitalCode"),
        F.lit(1.0).alias("min"),
        F.col("value").cast("double").alias("max"),
        F.lit(60).alias("sustainSeconds"),
        F.lit("LOW").alias("severity"),
        F.when(F.col("event_id") % 3 == 0, "DELETE").otherwise("UPSERT").alias("op"),
        "ts",
        "event_id",
    )
    return rules.versions(commands, ["ruleId"], "ts", rules.RULE_FIELDS, ["event_id"])


@query(
    "threshold_alerts_large",
    """WITH cmd AS (SELECT concat_ws('-', event_type, user_id % 8) AS rule_id, ts, value AS hi, event_type AS vital, event_id % 3 <> 0 AS held,
        CASE user_id % 8 % 3 WHEN 0 THEN '*' WHEN 1 THEN 'ICU-A' ELSE 'ICU-B' END AS ward,
        lead(ts) OVER (PARTITION BY event_type, user_id % 8 ORDER BY ts, event_id) AS vt FROM events),
      rd AS (SELECT event_id, ts, concat('P-', user_id) AS patient, CASE WHEN user_id % 2 = 0 THEN 'ICU-A' ELSE 'ICU-B' END AS ward, event_type AS vital, value FROM events),
      cand AS (SELECT rd.*, rule_id, cmd.ward AS rule_ward, hi, max(cmd.ward <> '*') OVER (PARTITION BY rd.event_id) AS own
        FROM rd JOIN cmd ON held AND cmd.vital = rd.vital AND cmd.ward IN ('*', rd.ward) AND cmd.ts <= rd.ts AND (vt IS NULL OR rd.ts < vt))
    SELECT event_id, patient AS "patientId", rule_id AS "ruleId", value FROM cand WHERE (rule_ward <> '*') = own AND (value < 1 OR value > hi)""",
)
def threshold_alerts_large(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts under a rule table that has as many versions as there are readings."""
    alerts = rules.threshold_alerts(ward_readings(spark, folder), changing_rules(spark, folder), "ts", ordered=True)
    return alerts.select("event_id", "patientId", "ruleId", "value")


def planned_readings(spark: SparkSession, folder: str) -> DataFrame:
    matched = rules.match_rules(ward_readings(spark, folder), rules_in_force(spark, folder), "ts")
    return rules.with_care_plan(matched, care_plans(spark, folder), "ts")


@query(
    "careplan_override",
    f"""WITH {PLANNED} SELECT event_id, patient AS "patientId", rule_id AS "ruleId", value, by_plan,
      CASE WHEN value < elo OR value > ehi THEN 'alert' ELSE 'suppressed' END AS route FROM planned WHERE value < elo OR value > ehi OR value < lo OR value > hi""",
)
def careplan_override(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts under care plans, and the alerts only a care plan holds back."""
    routed = planned_readings(spark, folder).where(F.col("route") != "ok")
    return routed.select("event_id", "patientId", "ruleId", "value", "by_plan", "route")


SUSTAINED = f"""fl AS (SELECT patient, rule_id, life_end, epoch_us(ts) AS us, event_id, sustain * 10000000::BIGINT AS wait_us, by_plan, (value < elo OR value > ehi) AS hot FROM planned),
      g AS (SELECT *, sum(CASE WHEN hot THEN 0 ELSE 1 END) OVER (PARTITION BY patient, rule_id, life_end ORDER BY us, event_id {ROWS_SO_FAR}) AS run FROM fl),
      ep AS (SELECT patient, rule_id, life_end, run, min(us) FILTER (hot) AS start_us, arg_min(wait_us, us) FILTER (hot) AS wait_us, arg_min(by_plan, us) FILTER (hot) AS by_plan FROM g GROUP BY ALL HAVING start_us IS NOT NULL),
      en AS (SELECT ep.*, (SELECT min(g.us) FROM g WHERE g.patient = ep.patient AND g.rule_id = ep.rule_id AND g.life_end IS NOT DISTINCT FROM ep.life_end AND g.run = ep.run + 1 AND NOT g.hot) AS end_us FROM ep),
      sustained AS (SELECT patient AS "patientId", rule_id AS "ruleId", make_timestamp(start_us) AS breach_start, make_timestamp(start_us + wait_us) AS alert_time, by_plan FROM en
    WHERE (end_us IS NULL OR end_us >= start_us + wait_us) AND start_us + wait_us <= (SELECT max(epoch_us(ts)) - 1000 FROM events)
      AND (life_end IS NULL OR start_us + wait_us < epoch_us(life_end)))"""


@query(
    "sustained_rule_breach",
    f"WITH {PLANNED}, {SUSTAINED} SELECT * FROM sustained",
)
def sustained_rule_breach(spark: SparkSession, folder: str) -> DataFrame:
    """Breaches that outlast their rule's sustain time (a second of the rule is ten here), and whether a care plan set their bounds."""
    until = inputs.watermark(inputs.events(spark, folder))
    return rules.sustained_rule_breach(planned_readings(spark, folder), "ts", until, ["event_id"], us_per_second=10_000_000)


@query(
    "rule_audit",
    f"""WITH {RULES}, r AS (SELECT *, lag(op) OVER w AS old_op, lag(min) OVER w AS old_min, lag(max) OVER w AS old_max FROM commands WHERE kind = 'RULE' WINDOW w AS (PARTITION BY "ruleId" ORDER BY ts, event_id))
    SELECT event_id, "ruleId", CASE WHEN op = 'DELETE' THEN 'removed' WHEN old_op = 'UPSERT' THEN 'changed' ELSE 'added' END AS change, old_min AS "oldMin", min, old_max AS "oldMax", max FROM r""",
)
def rule_audit(spark: SparkSession, folder: str) -> DataFrame:
    audit = rules.rule_audit(rule_commands(spark, folder), "ts", ["event_id"])
    return audit.select("event_id", "ruleId", "change", "oldMin", "min", "oldMax", "max")


# ---- paging ----


def breach_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Events above 50 as alerts: type, severity by value, ward as shard."""
    rows = inputs.events(spark, folder).where(F.col("value") > 50)
    severity = F.when(F.col("value") > 150, "HIGH").when(F.col("value") > 90, "MEDIUM").otherwise("LOW")
    return rows.select(
        "event_id", "user_id", F.col("event_type").alias("alert_type"), severity.alias("severity"), "ts",
        (F.col("user_id") % 2).alias("shard"),
    )


ALERTS = f"""{EV}, al AS (SELECT event_id, user_id, event_type AS alert_type, CASE WHEN value > 150 THEN 'HIGH' WHEN value > 90 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
  ts, epoch_us(ts) AS us, user_id % 2 AS shard, concat(user_id, '|', event_type) AS who FROM ev WHERE value > 50)"""


def page_fold(source: str, order: str) -> str:
    """Pages of ten or up to an urgent alert, one row at a time in each shard."""
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY {order}) AS rn FROM {source}),
      fold AS (SELECT shard, rn, severity, ts, 1 AS held, 1 AS page FROM numbered WHERE rn = 1
        UNION ALL SELECT n.shard, n.rn, n.severity, n.ts, CASE WHEN f.held = 10 OR f.severity = 'HIGH' THEN 1 ELSE f.held + 1 END,
          CASE WHEN f.held = 10 OR f.severity = 'HIGH' THEN f.page + 1 ELSE f.page END FROM fold f JOIN numbered n ON n.shard = f.shard AND n.rn = f.rn + 1)
    SELECT shard, count(*) AS alerts, max(CASE WHEN severity = 'HIGH' THEN 1 ELSE 0 END) AS has_urgent, min(ts) AS first_alert, max(ts) AS flushed_at
    FROM fold GROUP BY shard, page HAVING count(*) = 10 OR max(CASE WHEN severity = 'HIGH' THEN 1 ELSE 0 END) = 1"""


@query(
    "page_batches",
    f"WITH RECURSIVE {ALERTS}, {page_fold('al', 'ts, event_id')}",
)
def page_batches(spark: SparkSession, folder: str) -> DataFrame:
    pages = paging.page_batches(breach_alerts(spark, folder), ["shard"], "ts", F.col("severity") == "HIGH", ["event_id"])
    return pages.drop("urgent_before", "page_in_run")


@query(
    "suppress_repeats",
    f"""WITH RECURSIVE {ALERTS}, {greedy_sql("al", "who", 24 * HOUR_US)}
    SELECT a.event_id, a.user_id, a.alert_type FROM al a JOIN kept k ON k.who = a.who AND k.us = a.us""",
)
def suppress_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """The same (patient, type) is not paged again within a day of its last page."""
    alerts = breach_alerts(spark, folder).select("event_id", "user_id", "alert_type", "ts")
    return paging.suppress_repeats(alerts, ["user_id", "alert_type"], "ts", "1 day", ["event_id"]).drop("ts")


@query(
    "suppress_repeats_dense",
    f"""WITH RECURSIVE t AS (SELECT event_id, event_type AS who, epoch_us(ts) AS us FROM events), {greedy_sql("t", "who", 2 * HOUR_US)}
    SELECT t.event_id, t.who FROM t JOIN kept k ON k.who = t.who AND k.us = t.us""",
)
def suppress_repeats_dense(spark: SparkSession, folder: str) -> DataFrame:
    """Few keys with many rows, so the walk runs through long unbroken runs."""
    alerts = inputs.events(spark, folder).select("event_id", F.col("event_type").alias("who"), "ts")
    return paging.suppress_repeats(alerts, ["who"], "ts", "2 hours", ["event_id"]).drop("ts")


#: the tables behind the union, and the union
BANDED = f"""t AS (SELECT *, {" + ".join(f"p{i}" for i in range(7))} AS total, greatest({", ".join(f"p{i}" for i in range(7))}) AS top FROM gaps WHERE missing = ''),
      b AS (SELECT *, CASE WHEN total >= 7 THEN 'HIGH' WHEN total >= 5 THEN 'MEDIUM' WHEN top = 3 THEN 'LOW-MEDIUM' ELSE 'LOW' END AS band FROM t),
      bands AS (SELECT * FROM b QUALIFY lag(band) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM band)"""
ALERT_PARTS = f"""{STATUS}, {PLANNED}, {SUSTAINED}, {SCORED.removeprefix(EV + ", ")}, {BANDED}, n AS (SELECT user_id, epoch_us(ts) AS us, lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM events)"""
ALERT_UNION = f"""SELECT concat('P-', user_id) AS patient_id, 'THRESHOLD' AS alert_type, CASE WHEN value > 150 THEN 'HIGH' WHEN value > 90 THEN 'MEDIUM' ELSE 'LOW' END AS severity, ts AS alert_time FROM events WHERE value > 50
  UNION ALL SELECT hospital, concat('BEDS_', status), CASE status WHEN 'FULL' THEN 'HIGH' WHEN 'HIGH' THEN 'MEDIUM' ELSE 'LOW' END, ts FROM changes
  UNION ALL SELECT concat('P-', user_id), 'SILENT', 'MEDIUM', make_timestamp(us + {12 * HOUR_US}) FROM n WHERE nx - us > {12 * HOUR_US} OR (nx IS NULL AND us + {12 * HOUR_US} <= (SELECT us FROM mark))
  UNION ALL SELECT concat('P-', user_id), 'RESUMED', 'LOW', make_timestamp(nx) FROM n WHERE nx - us > {12 * HOUR_US}
  UNION ALL SELECT "patientId", concat('SUSTAINED_', "ruleId"), 'HIGH', alert_time FROM sustained
  UNION ALL SELECT concat('P-', user_id), concat('NEWS2_', band), CASE band WHEN 'HIGH' THEN 'HIGH' WHEN 'MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END, ts FROM bands"""


@query("union_alerts", f"WITH {ALERT_PARTS} {ALERT_UNION}")
def union_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Threshold, occupancy, silence and sustained alerts and changes of score band as one stream of one shape."""
    patient = F.concat(F.lit("P-"), F.col("user_id").cast("string")).alias("patient_id")
    breaches = breach_alerts(spark, folder).select(
        patient, F.lit("THRESHOLD").alias("alert_type"), "severity", F.col("ts").alias("alert_time")
    )
    grade = F.when(F.col("status") == "FULL", "HIGH").when(F.col("status") == "HIGH", "MEDIUM").otherwise("LOW")
    beds = bed_status_changes(spark, folder).select(
        F.col("hospital").alias("patient_id"), F.concat(F.lit("BEDS_"), F.col("status")).alias("alert_type"),
        grade.alias("severity"), F.col("ts").alias("alert_time"),
    )
    rows = inputs.events(spark, folder)
    quiet = detect.silence_resume(rows, ["user_id"], "ts", "12 hours", inputs.watermark(rows), ["event_id"]).select(
        patient, F.col("alert").alias("alert_type"),
        F.when(F.col("alert") == "SILENT", "MEDIUM").otherwise("LOW").alias("severity"), "alert_time",
    )
    lasting = sustained_rule_breach(spark, folder).select(
        F.col("patientId").alias("patient_id"), F.concat(F.lit("SUSTAINED_"), F.col("ruleId")).alias("alert_type"), F.lit("HIGH").alias("severity"), "alert_time"
    )
    scores = vitals.news2_changes(vital_readings(spark, folder), "user_id", "ts", "code", "v", ["event_id"], _FRESH_FOR)
    banded = vitals.band_changes(scores, "user_id", "ts", ["event_id"]).select(
        patient, F.concat(F.lit("NEWS2_"), F.col("band")).alias("alert_type"),
        F.when(F.col("band").isin("HIGH", "MEDIUM"), F.col("band")).otherwise("LOW").alias("severity"), F.col("ts").alias("alert_time"),
    )
    return paging.union_alerts(breaches, beds, quiet, lasting, banded)


@query(
    "paged_alerts",
    f"""WITH RECURSIVE {ALERT_PARTS}, un AS ({ALERT_UNION}),
    sent AS (SELECT *, alert_time AS ts, epoch_us(alert_time) AS us, concat(patient_id, '|', alert_type) AS who, ascii(right(patient_id, 1)) % 2 AS shard FROM un),
    nxt AS (SELECT DISTINCT who, us, min(us) OVER (PARTITION BY who ORDER BY us RANGE BETWEEN {24 * HOUR_US} FOLLOWING AND UNBOUNDED FOLLOWING) AS nu FROM sent),
    paged AS (SELECT who, min(us) AS us FROM sent GROUP BY ALL
      UNION ALL SELECT n.who, n.nu FROM paged k JOIN nxt n ON n.who = k.who AND n.us = k.us WHERE n.nu IS NOT NULL),
    quiet AS (SELECT s.* FROM sent s JOIN paged k ON k.who = s.who AND k.us = s.us), {page_fold("quiet", "ts, patient_id, alert_type, severity")}""",
)
def paged_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """All kinds of alerts, each patient and type at most once a day, batched into pages per shard."""
    alerts = union_alerts(spark, folder).withColumnRenamed("alert_time", "ts")
    quiet = paging.suppress_repeats(alerts, ["patient_id", "alert_type"], "ts", "1 day", ["severity"])
    shard = (F.ascii(F.right("patient_id", F.lit(1))) % 2).alias("shard")
    pages = paging.page_batches(quiet.select("*", shard), ["shard"], "ts", F.col("severity") == "HIGH", ["patient_id", "alert_type", "severity"])
    return pages.drop("urgent_before", "page_in_run")
