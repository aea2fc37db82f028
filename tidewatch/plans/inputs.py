"""How the given tables play the part of the streams, and the same views as SQL.

``events`` is the stream: ``ts`` is event time, ``user_id`` the key, ``value`` the
measurement.  Amounts are kept as whole hundredths (``cents``) so sums are exact.
``customer`` -> ``nation`` -> ``region`` is the registry: a nation is a hospital, its region
the hospital's region; the nations of one region are left out of the registry and so play
the unknown hospitals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.draw import length_of_stay_ms
from tidewatch.operators.occupancy import closed_until
from tidewatch.operators.timeline import Sample, planning_sample
from tidewatch.sources.tables import read_events, read_table

DAY_MS = 86_400_000
UNLISTED = "MIDDLE EAST"
CAPACITY = {"AFRICA": 200, "AMERICA": 170, "ASIA": 300, "EUROPE": 100}
REGION_ORDER = list(CAPACITY)
STAYS = {"EUROPE": (20 * DAY_MS, 60 * DAY_MS), "*": (5 * DAY_MS, 15 * DAY_MS)}


def events(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_events(spark, f"{folder}/events.parquet")
    return rows.withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """Hospital, region and beds.  nation has 25 rows and region 5 at every scale."""
    nation = read_table(spark, folder, "nation", "n_name", "n_regionkey")
    region = F.broadcast(read_table(spark, folder, "region"))
    listed = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).where(F.col("r_name") != UNLISTED)
    beds = F.lit(CAPACITY["EUROPE"])
    for name, n in CAPACITY.items():
        beds = F.when(F.col("r_name") == name, F.lit(n)).otherwise(beds)
    return listed.select(F.col("n_name").alias("hospital"), F.col("r_name").alias("region"), beds.cast("int").alias("capacity"))


def event_stream(spark: SparkSession, folder: str, delay: str = "1 millisecond") -> DataFrame:
    # as a pattern the path may be one file or a directory of files; it matches this one name
    rows = read_events(spark, f"{folder}/event[s].parquet", stream=True, delay=delay)
    return rows.withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))


def admissions(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> DataFrame:
    """Events (or the given rows of the same columns) with hospital, region and capacity; unknown hospitals get a null region and -1.

    customer grows with the data and is joined as Catalyst sees fit (adaptive skew join);
    nation and the registry are at most 25 rows and broadcast.
    """
    customer = read_table(spark, folder, "customer", "c_custkey", "c_nationkey")
    nation = F.broadcast(read_table(spark, folder, "nation", "n_nationkey", "n_name"))
    listed = F.broadcast(registry(spark, folder))
    rows = events(spark, folder) if rows is None else rows
    rows = rows.join(customer, F.col("user_id") == F.col("c_custkey"), "left")
    rows = rows.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    rows = rows.withColumnRenamed("n_name", "hospital").join(listed, "hospital", "left")
    kept = ["event_id", "ts", "user_id", "event_type", "value", "cents", "hospital", "region"]
    return rows.select(*kept, F.coalesce("capacity", F.lit(-1)).alias("capacity"))


def admission_sample(spark: SparkSession, folder: str) -> Sample:
    """Admissions for counting hospitals and regions without joining the whole stream."""
    part = planning_sample(events(spark, folder))
    return Sample(admissions(spark, folder, part.rows), part.weight)


def stay_ms() -> Column:
    return length_of_stay_ms("event_id", "region", STAYS)


def watermark(rows: DataFrame) -> int:
    return closed_until(rows, "ts")


# ---- the same inputs for the comparison SQL ----

EV = "ev AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events)"

REG = """reg AS (
  SELECT n_name AS hospital, r_name AS region,
    CASE r_name WHEN 'AFRICA' THEN 200 WHEN 'AMERICA' THEN 170 WHEN 'ASIA' THEN 300 ELSE 100 END AS capacity
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST')"""

ADM = f"""{EV}, {REG}, adm AS (
  SELECT event_id, ts, user_id, event_type, value, cents, n.n_name AS hospital, reg.region,
    coalesce(reg.capacity, -1) AS capacity
  FROM ev LEFT JOIN customer ON user_id = c_custkey
  LEFT JOIN nation n ON c_nationkey = n.n_nationkey
  LEFT JOIN reg ON reg.hospital = n.n_name)"""


def draw_sql(key: str, low: str, high: str) -> str:
    number = f"CAST(concat('0x', substr(md5(CAST({key} AS VARCHAR)), 1, 15)) AS BIGINT)"
    return f"({low} + {number} % ({high} - {low} + 1))"


_LOW = f"(CASE WHEN region = 'EUROPE' THEN {20 * DAY_MS} ELSE {5 * DAY_MS} END)"
_HIGH = f"(CASE WHEN region = 'EUROPE' THEN {60 * DAY_MS} ELSE {15 * DAY_MS} END)"
STAY = draw_sql("event_id", _LOW, _HIGH)

STAYED = f"""{ADM}, stayed AS (SELECT *, epoch_us(ts) + {STAY} * 1000 AS due_us, {STAY} AS stay_ms FROM adm),
  mark AS (SELECT max(epoch_us(ts)) - 1000 AS us FROM events)"""
