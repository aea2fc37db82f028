"""The streaming forms run to the end of the event table, compared on what the watermark closed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import admissions as adm_ops
from tidewatch.operators import joins, windows
from tidewatch.functions import frames
from tidewatch.operators.windows import span_us
from tidewatch.plans import inputs
from tidewatch.plans.catalog import query
from tidewatch.plans.inputs import ADM, EV, STAYED
from tidewatch.plans.state_queries import DEFAULT_RULES, PLANNED, RESIZED, RULE_SCRIPT, STATUS, SUSTAINED, capacity_updates, ward_readings
from tidewatch.plans.window_queries import _INTERVAL, REGIONAL, ROWS_SO_FAR, TTL
from tidewatch.session import ROCKSDB_PROVIDER
from tidewatch.sources.sinks import checkpoint_folder, write_labelled
from tidewatch.sources.tables import read_stream
from tidewatch.streaming import pipelines

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
MARK = "(SELECT max(epoch_us(ts)) - 1000 FROM events)"


def drained(spark: SparkSession, name: str, stream: DataFrame) -> DataFrame:
    """Run a stream over all its input into files and read them back."""
    folder = checkpoint_folder(spark, f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(PROVIDER_CONF)
    spark.conf.set(PROVIDER_CONF, ROCKSDB_PROVIDER)
    try:
        write_labelled(stream, name, f"{folder}/state", "parquet", path=f"{folder}/rows").awaitTermination()
    finally:
        spark.conf.set(PROVIDER_CONF, before)
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


@query(
    "stream_regional_count",
    f"WITH {ADM}, r AS ({REGIONAL} GROUP BY ALL) SELECT * FROM r WHERE epoch_us(window_end) <= {MARK}",
)
def stream_regional_count(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.admissions(spark, folder, inputs.event_stream(spark, folder))
    counted = adm_ops.measure_by_region(rows, "ts", "region", interval="1 hour", counted=[adm_ops.senior("value")])
    return drained(spark, "stream_regional_count", counted)


@query(
    "stream_sessions",
    f"""WITH {EV}, m AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) <= 21600000000 THEN 0 ELSE 1 END AS opens FROM ev),
      g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts {ROWS_SO_FAR}) AS trip FROM m),
      s AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '6 hours' AS session_end, sum(cents)::BIGINT AS cents, count(*) AS n FROM g GROUP BY user_id, trip)
    SELECT * FROM s WHERE epoch_us(session_end) <= {MARK}""",
)
def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    aggs = {"cents": F.sum("cents"), "n": F.count("cents")}
    trips = windows.sessions(inputs.event_stream(spark, folder), "ts", "6 hours", ["user_id"], aggs)
    return drained(spark, "stream_sessions", trips)


@query("stream_interval_join", f"SELECT user_id, purchase_id, signup_id {_INTERVAL.format(how='')}")
def stream_interval_join(spark: SparkSession, folder: str) -> DataFrame:
    def side(kind: str, prefix: str) -> DataFrame:
        rows = inputs.event_stream(spark, folder).where(F.col("event_type") == kind)
        return rows.select("user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))

    pairs = joins.interval_join(
        side("purchase", "purchase"), side("signup", "signup"), ["user_id"], "purchase_ts", "signup_ts", "0 seconds", "6 hours"
    )
    return drained(spark, "stream_interval_join", pairs.select("user_id", "purchase_id", "signup_id"))


@query(
    "stream_deferred_emit",
    f"WITH {STAYED} SELECT hospital, event_id, make_timestamp(due_us) AS due_time FROM stayed WHERE due_us <= (SELECT us FROM mark) // 1000 * 1000",
)
def stream_deferred_emit(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.admissions(spark, folder, inputs.event_stream(spark, folder))
    emitted = pipelines.deferred_emit(rows, "hospital", "ts", inputs.stay_ms(), ["event_id"], slot="1 hour", spread="event_id", shards=16)
    return drained(spark, "stream_deferred_emit", emitted)


@query(
    "stream_occupancy_alerts",
    f"WITH {STATUS} SELECT hospital, region, event_id, ts, previous_status, status, occupied, capacity, occupancy_pct FROM changes WHERE epoch_us(ts) <= {MARK} // 1000 * 1000",
)
def stream_occupancy_alerts(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.admissions(spark, folder, inputs.event_stream(spark, folder))
    alerts = pipelines.occupancy_alerts(rows, "hospital", "ts", inputs.stay_ms(), "capacity", "region", "event_id", slot="1 hour", shards=4)
    return drained(spark, "stream_occupancy_alerts", alerts).withColumnRenamed("tie", "event_id")


@query(
    "stream_ttl_running_sum",
    f"""WITH {TTL.format(ev=EV, gap=24 * 3600 * 1000000, rows=ROWS_SO_FAR)}
    SELECT event_id, user_id, live_sum, live_count FROM live WHERE epoch_us(ts) <= {MARK} // 1000 * 1000""",
)
def stream_ttl_running_sum(spark: SparkSession, folder: str) -> DataFrame:
    live = pipelines.expiring_sum(inputs.event_stream(spark, folder), "user_id", "ts", "cents", "24 hours", "event_id", slot="1 day")
    return drained(spark, "stream_ttl_running_sum", live).withColumnRenamed("tie", "event_id").drop("ts")


@query(
    "stream_dynamic_capacity",
    f"""WITH {RESIZED}, closed AS (SELECT least((SELECT max(us) FROM sized), (SELECT max(epoch_us(ts)) FROM events)) - 1000 AS us)
    SELECT hospital, event_id, make_timestamp(us) AS ts, previous_status, status, occupied, capacity FROM moved
    WHERE status <> previous_status AND us <= (SELECT us FROM closed) // 1000 * 1000""",
)
def stream_dynamic_capacity(spark: SparkSession, folder: str) -> DataFrame:
    """Two inputs that advance apart: capacities are known up to the middle of the month, so results stop there."""
    rows = inputs.admissions(spark, folder, inputs.event_stream(spark, folder))
    updates = capacity_updates(spark, folder, read_stream(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderdate"))
    changes = pipelines.dynamic_capacity(rows, updates, "hospital", "ts", inputs.stay_ms(), "capacity", "event_id", slot="1 hour")
    named = drained(spark, "stream_dynamic_capacity", changes).withColumnRenamed("tie", "event_id")
    return named.select("hospital", "event_id", "ts", "previous_status", "status", "occupied", "capacity")


def command_stream(spark: SparkSession, name: str) -> DataFrame:
    """The clinicians' rule script as a live feed: lines arrive as files, with an event time of their own."""
    feed = checkpoint_folder(spark, f"{name}-feed-{uuid.uuid4().hex}")
    lines = spark.createDataFrame(RULE_SCRIPT, "at string, line string").select(F.col("at").cast("timestamp").alias("ts"), "line")
    lines.write.parquet(feed)
    return frames.parse_rules(spark.readStream.schema(lines.schema).parquet(feed).withWatermark("ts", "1 millisecond"), "line")


#: the time up to which both the readings and the rule script are complete
RULES_MARK = "(SELECT least((SELECT max(epoch_us(ts)) FROM events), (SELECT max(epoch_us(ts)) FROM script)) - 1000) // 1000 * 1000"


def monitored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    readings = ward_readings(spark, folder, inputs.event_stream(spark, folder))
    watched = pipelines.rule_monitor(readings, command_stream(spark, name), "ts", "event_id", DEFAULT_RULES, shards=8, us_per_second=10_000_000, slot="1 hour")
    return drained(spark, name, watched)


@query("stream_sustained_rule_breach", f"WITH {PLANNED}, {SUSTAINED} SELECT * FROM sustained WHERE epoch_us(alert_time) <= {RULES_MARK}")
def stream_sustained_rule_breach(spark: SparkSession, folder: str) -> DataFrame:
    """Sustained breaches under rules and care plans that change while the readings stream in."""
    sustained = monitored(spark, folder, "stream_sustained_rule_breach").where("tag = 'sustained'")
    return sustained.select("patientId", "ruleId", "breach_start", "alert_time", "by_plan")


@query(
    "stream_careplan_override",
    f"""WITH {PLANNED} SELECT event_id, patient AS "patientId", rule_id AS "ruleId", value, by_plan,
      CASE WHEN value < elo OR value > ehi THEN 'alert' ELSE 'suppressed' END AS route FROM planned
      WHERE (value < elo OR value > ehi OR value < lo OR value > hi) AND epoch_us(ts) <= {RULES_MARK}""",
)
def stream_careplan_override(spark: SparkSession, folder: str) -> DataFrame:
    """Threshold alerts under live rules, and the alerts only a care plan holds back."""
    routed = monitored(spark, folder, "stream_careplan_override").where("tag <> 'sustained'")
    return routed.select("event_id", "patientId", "ruleId", "value", "by_plan", F.col("tag").alias("route"))


ROLLING_PANE, ROLLING_PANES = "1 hour", 24


@query(
    "stream_rolling_sum",
    f"""WITH {EV}, p AS (SELECT *, epoch_us(ts) // {span_us(ROLLING_PANE)} AS pane FROM ev)
    SELECT a.event_id, a.user_id, sum(b.cents)::BIGINT AS rolling_sum, count(*) AS rolling_count FROM p a JOIN p b ON a.user_id = b.user_id
      AND b.pane > a.pane - {ROLLING_PANES} AND (b.ts, b.event_id) <= (a.ts, a.event_id) WHERE epoch_us(a.ts) <= {MARK} // 1000 * 1000 GROUP BY ALL""",
)
def stream_rolling_sum(spark: SparkSession, folder: str) -> DataFrame:
    """Spend of the last 24 hourly panes at every event."""
    rolled = pipelines.rolling_panes(inputs.event_stream(spark, folder), "user_id", "ts", "cents", ROLLING_PANE, ROLLING_PANES, "event_id", slot="1 hour")
    return drained(spark, "stream_rolling_sum", rolled).withColumnRenamed("tie", "event_id").drop("ts")


@query(
    "stream_duration_stats",
    f"""WITH {STAYED}, h AS (SELECT coalesce(region, '?') AS region, time_bucket(INTERVAL '1 day', ts) AS window_start, count(*) AS n, sum(stay_ms::HUGEINT) AS s,
        sum(stay_ms::HUGEINT * stay_ms) AS q, max(stay_ms) AS hi FROM stayed GROUP BY ALL),
      r AS (SELECT region, window_start, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q, max(hi) OVER w AS hi FROM h
        WINDOW w AS (PARTITION BY region ORDER BY window_start {ROWS_SO_FAR}))
    SELECT region, window_start, n::BIGINT AS n, round(s::DOUBLE / n::DOUBLE, 3) AS mean_stay_ms, hi AS max_stay_ms FROM r
    WHERE epoch_us(window_start) + 86400000000 <= {MARK}""",
)
def stream_duration_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Length-of-stay statistics per region so far, at the end of every day."""
    rows = inputs.admissions(spark, folder, inputs.event_stream(spark, folder)).withColumn("stay", inputs.stay_ms())
    rows = rows.withColumn("region", F.coalesce("region", F.lit("?")))
    stats = drained(spark, "stream_duration_stats", pipelines.running_moments(rows, "region", "ts", F.col("stay"), "1 day", F.col("event_id"), salts=8))
    return stats.select("region", "window_start", "n", F.round("mean", 3).alias("mean_stay_ms"), F.col("max").alias("max_stay_ms"))
