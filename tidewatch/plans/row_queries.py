"""Filter, map, flatMap, parsing and scalar queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import frames, render
from tidewatch.functions.lookup import lookup_async
from tidewatch.operators import admissions as adm_ops
from tidewatch.operators import rows as ops
from tidewatch.operators.joins import enrich
from tidewatch.operators.windows import tumbling
from tidewatch.plans import inputs
from tidewatch.plans.catalog import query
from tidewatch.plans.inputs import ADM, EV, STAY
from tidewatch.sources.tables import read_table


@query("scan_events", "SELECT event_id, ts, user_id, event_type, value FROM events")
def scan_events(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.events(spark, folder).select("event_id", "ts", "user_id", "event_type", "value")


@query(
    "fanout_counts",
    """SELECT 'total' AS consumer, 'all' AS label, count(*) AS n FROM events
    UNION ALL SELECT 'by_type', event_type, count(*) FROM events GROUP BY event_type
    UNION ALL SELECT 'faulty', 'error', count(*) FROM events WHERE event_type = 'error'""",
)
def fanout_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Three independent consumers of one stream, each of which sees every row, in one pass over it."""
    rows = inputs.events(spark, folder)

    def sees(consumer: str, label: Column) -> Column:
        return F.struct(F.lit(consumer).alias("consumer"), label.alias("label"))

    faulty = F.when(F.col("event_type") == "error", sees("faulty", F.lit("error")))
    consumers = F.array_compact(F.array(sees("total", F.lit("all")), sees("by_type", F.col("event_type")), faulty))
    # counted per type before the rows are handed on, so a consumer adds up a few numbers
    by_type = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    handed = by_type.select(F.explode(consumers).alias("to"), "n").select("to.consumer", "to.label", "n")
    # two of the consumers report a 0 as well
    none = spark.createDataFrame([("total", "all", 0), ("faulty", "error", 0)], handed.schema)
    return handed.union(none).groupBy("consumer", "label").agg(F.sum("n").alias("n"))


def faulty_readings(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.events(spark, folder)
    temperature = F.when(F.col("event_type") == "error", F.lit(float(ops.FAULTY))).otherwise(F.col("value"))
    return rows.withColumn("temperature", temperature)


@query("filter_faulty", "SELECT event_id, user_id, value AS temperature FROM events WHERE event_type <> 'error'")
def filter_faulty(spark: SparkSession, folder: str) -> DataFrame:
    return ops.drop_faulty(faulty_readings(spark, folder), "temperature").select("event_id", "user_id", "temperature")


@query("filter_region", f"WITH {ADM} SELECT event_id, hospital, region FROM adm WHERE region = 'ASIA'")
def filter_region(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.admissions(spark, folder).where(F.col("region") == "ASIA").select("event_id", "hospital", "region")


@query(
    "map_fahrenheit",
    """SELECT event_id, floor((value * 9 / 5 + 32) * 10 + 0.5) / 10.0 AS fahrenheit,
      concat('sensor-', user_id, ' is at ', CAST(floor((value * 9 / 5 + 32) * 10 + 0.5) / 10.0 AS VARCHAR), ' F') AS line
    FROM events WHERE event_type <> 'error'""",
)
def map_fahrenheit(spark: SparkSession, folder: str) -> DataFrame:
    valid = ops.drop_faulty(faulty_readings(spark, folder), "temperature")
    degrees = ops.to_fahrenheit(F.col("temperature"))
    line = F.concat(F.lit("sensor-"), F.col("user_id").cast("string"), F.lit(" is at "), degrees.cast("string"), F.lit(" F"))
    return valid.select("event_id", degrees.alias("fahrenheit"), line.alias("line"))


@query(
    "flatmap_warnings",
    """SELECT event_id, concat(user_id, ' is warm (', CAST(value AS VARCHAR), 'C)') AS warning
    FROM events WHERE event_type <> 'error' AND value >= 28
    UNION ALL SELECT event_id, concat(user_id, ' is DANGEROUSLY HOT (', CAST(value AS VARCHAR), 'C)')
    FROM events WHERE event_type <> 'error' AND value > 32""",
)
def flatmap_warnings(spark: SparkSession, folder: str) -> DataFrame:
    valid = ops.drop_faulty(faulty_readings(spark, folder), "temperature")
    return ops.temperature_warnings(valid, "user_id", "temperature").select("event_id", "warning")


WORDS = """words AS (SELECT doc_id, CAST(unnest(range(len(l))) AS INTEGER) AS position, unnest(l) AS word FROM
  (SELECT doc_id, string_split(rtrim(text, ' '), ' ') AS l FROM documents WHERE rtrim(text, ' ') <> '' OR text = ''))"""


@query("split_words", f"WITH {WORDS} SELECT doc_id, position, word FROM words")
def split_words(spark: SparkSession, folder: str) -> DataFrame:
    return ops.split_words(read_table(spark, folder, "documents", "doc_id", "text"), "text")


@query(
    "unnest_items",
    """SELECT l_orderkey, l_linenumber, l_partkey, 'price' AS kind, l_extendedprice AS amount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'discount', -l_extendedprice * l_discount FROM lineitem WHERE l_discount > 0
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'tax', l_extendedprice * l_tax FROM lineitem WHERE l_tax > 0""",
)
def unnest_items(spark: SparkSession, folder: str) -> DataFrame:
    """Each line carries an array of charge records (two to none left out); one row per record."""
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")

    def charge(kind: str, amount):
        return F.struct(F.lit(kind).alias("kind"), amount.alias("amount"))

    records = F.array_compact(
        F.array(
            charge("price", price),
            F.when(discount > 0, charge("discount", -price * discount)),
            F.when(tax > 0, charge("tax", price * tax)),
        )
    )
    lines = read_table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_tax")
    nested = lines.select("l_orderkey", "l_linenumber", "l_partkey", records.alias("charges"))
    return ops.unnest(nested, "charges")


CSV_LINE = """CASE event_type WHEN 'error' THEN 'INVALID' WHEN 'signup' THEN concat(event_id, ',', event_type, ',unknown')
  WHEN 'view' THEN concat(event_id, ',', event_type, ',', user_id, ',extra') ELSE concat(event_id, ',', event_type, ',', user_id) END"""


@query(
    "parse_or_drop",
    f"""WITH lines AS (SELECT string_split({CSV_LINE}, ',') AS f FROM events)
    SELECT CAST(f[1] AS BIGINT) AS id, f[2] AS name, CAST(f[3] AS INTEGER) AS age FROM lines
    WHERE len(f) = 3 AND try_cast(f[3] AS INTEGER) IS NOT NULL AND try_cast(f[1] AS BIGINT) IS NOT NULL""",
)
def parse_or_drop(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.events(spark, folder).select(F.expr(CSV_LINE).alias("line"))
    return ops.parse_delimited(lines, "line", [("id", "bigint"), ("name", "string"), ("age", "int")])


TYPED_LINE = """CASE event_type WHEN 'signup' THEN concat('LOGIN,C', user_id) WHEN 'click' THEN concat('LOGOUT,C', user_id)
  WHEN 'purchase' THEN concat('PURCHASE,C', user_id, ',P', event_id, ',', value)
  WHEN 'view' THEN concat('VIEW,C', user_id) ELSE concat('PURCHASE,C', user_id) END"""


@query(
    "route_by_type",
    """SELECT event_id, CASE event_type WHEN 'signup' THEN 'LOGIN' WHEN 'click' THEN 'LOGOUT' ELSE 'PURCHASE' END AS kind,
      concat('C', user_id) AS customer, CASE WHEN event_type = 'purchase' THEN concat('P', event_id) END AS product,
      CASE WHEN event_type = 'purchase' THEN value END AS amount
    FROM events WHERE event_type IN ('signup', 'click', 'purchase')""",
)
def route_by_type(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.events(spark, folder).select("event_id", F.expr(TYPED_LINE).alias("line"))
    return ops.route_by_type(lines, "line")


@query(
    "wide_to_long",
    """SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS reading FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""",
)
def wide_to_long(spark: SparkSession, folder: str) -> DataFrame:
    measures = ["l_quantity", "l_discount", "l_tax"]
    lines = read_table(spark, folder, "lineitem", "l_orderkey", "l_linenumber", *measures)
    return ops.wide_to_long(lines, ["l_orderkey", "l_linenumber"], measures)


@query(
    "multi_alerts",
    """SELECT event_id, concat('MEASUREMENT:', user_id) AS output FROM events
    UNION ALL SELECT event_id, concat('ALERT:', user_id) FROM events WHERE value > 70
    UNION ALL SELECT event_id, concat('AUDIT:', user_id) FROM events""",
)
def multi_alerts(spark: SparkSession, folder: str) -> DataFrame:
    who = F.col("user_id").cast("string")
    rows = inputs.events(spark, folder).select("event_id", "user_id", "value")
    fanned = ops.fan_rows(
        rows,
        F.concat(F.lit("MEASUREMENT:"), who),
        F.when(F.col("value") > 70, F.concat(F.lit("ALERT:"), who)),
        F.concat(F.lit("AUDIT:"), who),
    )
    return fanned.select("event_id", "output")


ENTITIES = {
    "email": "[A-Za-z0-9._]+@[A-Za-z0-9.]+",
    "url": "https?://[A-Za-z0-9./_-]+",
    "number": "[0-9][0-9]+",
}


@query(
    "extract_entities",
    " UNION ALL ".join(
        f"SELECT doc_id, '{kind}' AS entity_type, unnest(regexp_extract_all(text, '{pattern}')) AS entity FROM documents"
        for kind, pattern in ENTITIES.items()
    ),
)
def extract_entities(spark: SparkSession, folder: str) -> DataFrame:
    return ops.extract_entities(read_table(spark, folder, "documents", "doc_id", "text"), "text", ENTITIES)


@query("keyed_draw", f"WITH {ADM} SELECT event_id, region, {STAY} AS stay_ms FROM adm")
def keyed_draw(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.admissions(spark, folder).select("event_id", "region", inputs.stay_ms().alias("stay_ms"))


# ---- device frames ----

FRAME = """CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN concat('VW9|MON-', user_id, '|P-', user_id, '|ICU-A|0|HR=80')
  WHEN event_type = 'error' AND event_id % 3 = 1 THEN concat('VW1|MON-', user_id, '|P-', user_id)
  WHEN event_type = 'error' THEN concat('VW1|MON-', user_id, '|P-', user_id, '|ICU-B|soon|HR=80')
  ELSE concat('VW1|MON-', user_id, '|P-', user_id, '|ICU-', CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END, '|', {ms}, '|HR=',
    CASE event_type WHEN 'signup' THEN 'abc' ELSE CAST(cents % 320 AS VARCHAR) END, ';SPO2=', CAST(cents % 108 AS VARCHAR),
    ';RR=', CAST(8 + cents % 20 AS VARCHAR), ';SBP=', CAST(80 + cents % 150 AS VARCHAR), ';TEMP=',
    CASE WHEN user_id % 2 = 0 THEN concat(CAST(90 + cents % 20 AS VARCHAR), 'F') ELSE concat(CAST(20 + cents % 28 AS VARCHAR), 'C') END,
    ';O2=', CASE WHEN cents % 2 = 0 THEN 'Y' ELSE 'N' END, ';CONSC=', substr('ACVPU', CAST(1 + cents % 5 AS INTEGER), 1)) END"""
FRAME_SPARK = FRAME.format(ms="unix_millis(ts)").replace(" AS VARCHAR)", " AS STRING)")
FRAME_SQL = FRAME.format(ms="(epoch_us(ts) // 1000)")


def device_frames(spark: SparkSession, folder: str) -> DataFrame:
    """A text frame per event; error events give malformed ones, signup events a garbled heart rate."""
    return inputs.events(spark, folder).select("event_id", F.col("ts").alias("ingested"), F.expr(FRAME_SPARK).alias("line"))


PARSED = f"""{EV}, lines AS (SELECT event_id, ts AS ingested, {FRAME_SQL} AS line FROM ev),
  parts AS (SELECT *, string_split(line, '|') AS f FROM lines),
  parsed AS (SELECT event_id, ingested, f[1] AS version, f[2] AS "deviceId", f[3] AS "patientId", f[4] AS "wardId",
    make_timestamp(try_cast(f[5] AS BIGINT) * 1000) AS timestamp, f[6] AS body,
    CASE WHEN len(f) <> 6 THEN concat('expected 6 fields, got ', len(f)) WHEN f[1] <> 'VW1' THEN concat('unknown version ', f[1])
      WHEN f[2] = '' OR f[3] = '' OR f[4] = '' THEN 'empty identifier' WHEN try_cast(f[5] AS BIGINT) IS NULL THEN 'bad timestamp'
      WHEN f[6] = '' THEN 'no measurements' END AS "parseError" FROM parts)"""


@query(
    "frame_parse",
    f"""WITH {PARSED} SELECT event_id, version, "deviceId", "patientId", "wardId", timestamp, "parseError",
      "parseError" IS NULL AS valid, CASE WHEN "parseError" IS NULL THEN CAST(len(string_split(body, ';')) AS INTEGER) END AS measurements
    FROM parsed""",
)
def frame_parse(spark: SparkSession, folder: str) -> DataFrame:
    parsed = frames.parse_frames(device_frames(spark, folder), "line").drop("ingested")
    return parsed.withColumn("measurements", F.when(F.col("valid"), F.size("measurements")))


READINGS = f"""{PARSED}, entries AS (SELECT event_id, ingested, "patientId", "wardId", timestamp, unnest(string_split(body, ';')) AS e
    FROM parsed WHERE "parseError" IS NULL),
  split_e AS (SELECT *, split_part(e, '=', 1) AS "vitalCode", split_part(e, '=', 2) AS raw FROM entries),
  readings AS (SELECT * FROM (SELECT event_id, ingested, "patientId", "wardId", timestamp, "vitalCode",
    CASE "vitalCode" WHEN 'TEMP' THEN CASE WHEN raw LIKE '%F' THEN (try_cast(raw[:-2] AS DOUBLE) - 32) * 5 / 9 ELSE try_cast(raw[:-2] AS DOUBLE) END
      WHEN 'O2' THEN CASE raw WHEN 'Y' THEN 1.0::DOUBLE WHEN 'N' THEN 0.0::DOUBLE END
      WHEN 'CONSC' THEN CASE raw WHEN 'A' THEN 0.0::DOUBLE WHEN 'C' THEN 1.0::DOUBLE WHEN 'V' THEN 2.0::DOUBLE WHEN 'P' THEN 3.0::DOUBLE WHEN 'U' THEN 4.0::DOUBLE END
      ELSE try_cast(raw AS DOUBLE) END AS value FROM split_e) WHERE value IS NOT NULL)"""


def device_readings(spark: SparkSession, folder: str) -> DataFrame:
    return frames.explode_frames(frames.parse_frames(device_frames(spark, folder), "line"))


@query("frame_explode", f'WITH {READINGS} SELECT "patientId", "wardId", timestamp, "vitalCode", value FROM readings')
def frame_explode(spark: SparkSession, folder: str) -> DataFrame:
    return device_readings(spark, folder).drop("deviceId")


@query("vital_counts", f'WITH {READINGS} SELECT "vitalCode", count(*) AS n FROM readings GROUP BY ALL')
def vital_counts(spark: SparkSession, folder: str) -> DataFrame:
    return device_readings(spark, folder).groupBy("vitalCode").agg(F.count(F.lit(1)).alias("n"))


@query(
    "quality_gate",
    f"""WITH {READINGS}, shifted AS (SELECT "patientId", "vitalCode", value, timestamp,
        CASE WHEN "vitalCode" = 'RR' AND value = 20 THEN make_timestamp(epoch_us(timestamp) - 600000000) ELSE timestamp END AS now FROM readings)
    SELECT "patientId", "vitalCode", value, timestamp,
      CASE WHEN epoch_ms(timestamp) - epoch_ms(now) > 300000 THEN 'clock-skew'
        WHEN "vitalCode" IN ('HR', 'SPO2') AND value = 0 THEN 'artifact'
        WHEN ("vitalCode" = 'HR' AND value NOT BETWEEN 20 AND 300) OR ("vitalCode" = 'SPO2' AND value NOT BETWEEN 50 AND 100)
          OR ("vitalCode" = 'TEMP' AND value NOT BETWEEN 25 AND 45) OR ("vitalCode" = 'RR' AND value NOT BETWEEN 1 AND 80)
          OR ("vitalCode" = 'SBP' AND value NOT BETWEEN 30 AND 300) THEN 'impossible' ELSE 'clean' END AS route,
      CASE WHEN epoch_ms(timestamp) - epoch_ms(now) > 300000 THEN epoch_ms(timestamp) - epoch_ms(now) END AS "skewMillis"
    FROM shifted""",
)
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Routes of every reading; the clock of the gate is ten minutes behind for one kind of reading."""
    readings = device_readings(spark, folder).drop("wardId", "deviceId")
    behind = (F.col("vitalCode") == "RR") & (F.col("value") == 20)
    now = F.when(behind, F.timestamp_micros(F.unix_micros("timestamp") - 600_000_000)).otherwise(F.col("timestamp"))
    return frames.quality_gate(readings, now)


RULE_LINE = """CASE event_type WHEN 'purchase' THEN concat('RULE|UPSERT|R-', user_id, '|', CASE WHEN event_id % 2 = 0 THEN '*' ELSE 'ICU-A' END,
    '|HR|', cents % 60, '|', 100 + cents % 60, '|', cents % 120, '|HIGH')
  WHEN 'signup' THEN concat('RULE|DELETE|R-', user_id)
  WHEN 'view' THEN concat('CAREPLAN|UPSERT|P-', user_id, '|SPO2|', 80 + cents % 10, '|100')
  WHEN 'click' THEN concat('CAREPLAN|DELETE|P-', user_id, '|SPO2')
  ELSE concat('RULE|UPSERT|R-', user_id, '|*|HR|low|high|60|HIGH') END"""


def rule_commands(spark: SparkSession, folder: str) -> DataFrame:
    """A rule-feed line per event; error events give malformed lines."""
    lines = inputs.events(spark, folder).select("event_id", "ts", F.expr(RULE_LINE).alias("line"))
    return frames.parse_rules(lines, "line")


RULES = f"""{EV}, feed AS (SELECT event_id, ts, string_split({RULE_LINE}, '|') AS f FROM ev),
  commands AS (SELECT event_id, ts, f[1] AS kind, f[2] AS op,
    CASE WHEN f[1] = 'RULE' THEN f[3] END AS "ruleId", CASE WHEN f[1] = 'RULE' AND f[2] = 'UPSERT' THEN f[4] END AS "wardId",
    CASE WHEN f[1] = 'CAREPLAN' THEN f[4] WHEN f[2] = 'UPSERT' THEN f[5] END AS "vitalCode",
    CASE WHEN f[1] = 'CAREPLAN' THEN f[3] END AS "patientId",
    try_cast(CASE WHEN f[2] = 'UPSERT' THEN CASE WHEN f[1] = 'RULE' THEN f[6] ELSE f[5] END END AS DOUBLE) AS min,
    try_cast(CASE WHEN f[2] = 'UPSERT' THEN CASE WHEN f[1] = 'RULE' THEN f[7] ELSE f[6] END END AS DOUBLE) AS max,
    try_cast(CASE WHEN f[1] = 'RULE' AND f[2] = 'UPSERT' THEN f[8] END AS INTEGER) AS "sustainSeconds",
    CASE WHEN f[1] = 'RULE' AND f[2] = 'UPSERT' THEN f[9] END AS severity
    FROM feed WHERE NOT (f[1] = 'RULE' AND f[2] = 'UPSERT' AND try_cast(f[6] AS DOUBLE) IS NULL))"""


@query("rule_parse", f"WITH {RULES} SELECT * FROM commands")
def rule_parse(spark: SparkSession, folder: str) -> DataFrame:
    return rule_commands(spark, folder)


# ---- text lines ----

HOURLY = f"""{ADM}, hourly AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, region, sum(CASE WHEN value > 65 THEN 1 ELSE 0 END)::BIGINT AS n
  FROM adm WHERE region IS NOT NULL GROUP BY ALL)"""


@query(
    "render_lines",
    f"""WITH {HOURLY} SELECT window_start, region, printf('[%s - %s] Region %-2s -> %3d admissions', strftime(window_start, '%H:%M:%S'),
      strftime(window_start + INTERVAL '1 hour', '%H:%M:%S'), region, n) AS line FROM hourly""",
)
def render_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.admissions(spark, folder).where(F.col("region").isNotNull())
    hourly = adm_ops.measure_by_region(rows, "ts", "region", interval="1 hour", counted=[adm_ops.senior("value")])
    return hourly.select("window_start", "region", render.regional_line("window_start", "window_end", "region", "n").alias("line"))


@query(
    "render_network",
    f"""WITH {ADM}, t AS (SELECT time_bucket(INTERVAL '1 day', ts) AS w, count(*) FILTER (value > 65) AS total,
        {", ".join(f"count(*) FILTER (value > 65 AND region = '{r}') AS {r.lower()}" for r in inputs.REGION_ORDER)} FROM adm GROUP BY ALL)
    SELECT w AS window_start, concat(chr(10), repeat('=', 50), chr(10),
      printf('  Admission Interval [%s - %s]', strftime(w, '%H:%M:%S'), strftime(w + INTERVAL '1 day', '%H:%M:%S')), chr(10),
      printf('  Total Admissions Across All 4 Regions: %d', total), chr(10), '  ', repeat('-', 48), chr(10),
      {", chr(10), ".join(f"printf('    - Region %-2s: %3d admissions (%5.1f%%)', '{r}', {r.lower()}, CASE WHEN total > 0 THEN floor({r.lower()} * 100.0::DOUBLE / total * 10 + 0.5) / 10.0::DOUBLE ELSE 0.0::DOUBLE END)" for r in inputs.REGION_ORDER)},
      chr(10), repeat('=', 50)) AS report FROM t""",
)
def render_network(spark: SparkSession, folder: str) -> DataFrame:
    daily = adm_ops.measure_all_regions(
        inputs.admissions(spark, folder), "ts", "region", inputs.REGION_ORDER, "1 day", [adm_ops.senior("value")]
    )
    report = render.network_report("window_start", "window_end", "total", inputs.REGION_ORDER)
    return daily.select("window_start", report.alias("report"))


@query(
    "render_readings",
    "SELECT event_id, concat('sensor-', user_id, ' ', CAST(value AS VARCHAR), 'C @', strftime(ts, '%H:%M:%S')) AS line FROM events",
)
def render_readings(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.events(spark, folder).withColumn("sensor", F.concat(F.lit("sensor-"), F.col("user_id").cast("string")))
    return rows.select("event_id", render.reading_line("sensor", "value", "ts").alias("line"))


@query(
    "render_positions",
    f"""WITH {EV} SELECT event_id, printf('Bus %s | Route %s | Location (%.4f, %.4f) | Speed %.1f mph | Passengers %d', CAST(user_id AS VARCHAR), event_type,
      (400000 + cents % 10000) / 10000.0::DOUBLE, (-740000 - cents % 10000) / 10000.0::DOUBLE, (cents // 10) / 10.0::DOUBLE, cents % 60) AS line FROM ev""",
)
def render_positions(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.events(spark, folder).withColumns(
        {
            "bus": F.col("user_id").cast("string"),
            "latitude": F.expr("(400000 + cents % 10000) / 10000D"),
            "longitude": F.expr("(-740000 - cents % 10000) / 10000D"),
            "speed": F.expr("(cents div 10) / 10D"),
            "passengers": F.expr("cents % 60"),
        }
    )
    return rows.select("event_id", render.gps_line("bus", "event_type", "latitude", "longitude", "speed", "passengers").alias("line"))


# ---- scalar functions ----


@query(
    "string_functions",
    """SELECT doc_id, concat(source, '/', lang) AS tag, string_split(concat(source, '/', lang), '/')[2] AS second,
      lower(text) AS lowered, printf('%.1f', floor(n_chars / 8.0::DOUBLE * 10 + 0.5) / 10.0::DOUBLE) AS eighth, printf('%-2s|%3d', lang, n_chars) AS padded FROM documents""",
)
def string_functions(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", "doc_id", "text", "lang", "source", "n_chars")
    tag = F.concat("source", F.lit("/"), "lang")
    eighth = F.format_string("%.1f", F.col("n_chars") / F.lit(8.0))
    return docs.select(
        "doc_id",
        tag.alias("tag"),
        F.split(tag, "/")[1].alias("second"),
        F.lower("text").alias("lowered"),
        eighth.alias("eighth"),
        F.format_string("%-2s|%3d", "lang", "n_chars").alias("padded"),
    )


@query(
    "math_functions",
    """SELECT event_id, floor(value * 10 + 0.5) / 10.0 AS round1, floor(value / 7 * 10000 + 0.5) / 10000.0 AS round4,
      value / 200 * 100.0 AS pct, CASE WHEN user_id <> 0 THEN value / user_id END AS safe_ratio,
      greatest(0, least(value, 100.0::DOUBLE)) AS clamped, floor(-value * 10 + 0.5) / 10.0 AS round_negative FROM events""",
)
def math_functions(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    return inputs.events(spark, folder).select(
        "event_id",
        ops.round_half_up(value, 1).alias("round1"),
        ops.round_half_up(value / 7, 4).alias("round4"),
        (value / 200 * 100.0).alias("pct"),
        F.try_divide(value, F.col("user_id")).alias("safe_ratio"),
        F.greatest(F.lit(0.0), F.least(value, F.lit(100.0))).alias("clamped"),
        ops.round_half_up(-value, 1).alias("round_negative"),
    )


@query(
    "time_functions",
    """SELECT event_id, (epoch_us(ts) // 1000) AS ms, make_timestamp((epoch_us(ts) // 1000) * 1000) AS back, strftime(ts, '%H:%M:%S') AS clock,
      make_timestamp(epoch_us(ts) + 90000000) AS later, CASE WHEN event_type = 'error' THEN 0 ELSE (epoch_us(ts) // 1000) END AS ms_or_zero FROM events""",
)
def time_functions(spark: SparkSession, folder: str) -> DataFrame:
    known = F.when(F.col("event_type") != "error", F.col("ts"))
    return inputs.events(spark, folder).select(
        "event_id",
        F.unix_millis("ts").alias("ms"),
        F.timestamp_millis(F.unix_millis("ts")).alias("back"),
        render.clock("ts").alias("clock"),
        (F.col("ts") + F.expr("interval 90 seconds")).alias("later"),
        F.coalesce(F.unix_millis(known), F.lit(0)).alias("ms_or_zero"),
    )


@query(
    "map_functions",
    f"""WITH {ADM}, c AS (SELECT time_bucket(INTERVAL '1 day', ts) AS w, region, count(*) AS n FROM adm WHERE region IS NOT NULL GROUP BY ALL),
      d AS (SELECT DISTINCT time_bucket(INTERVAL '1 day', ts) AS w FROM adm),
      r AS (SELECT unnest(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'ATLANTIS']) AS region)
    SELECT d.w AS window_start, r.region, coalesce(c.n, 0) AS n, coalesce(c.n, 0) + 1 AS n_plus FROM d CROSS JOIN r LEFT JOIN c ON c.w = d.w AND c.region = r.region""",
)
def map_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Counts as a map with fixed keys; entries read back with a default, and one added to each."""
    daily = adm_ops.measure_all_regions(
        inputs.admissions(spark, folder), "ts", "region", inputs.REGION_ORDER, "1 day", [F.lit(True)]
    )
    counts = daily.select("window_start", adm_ops.counts_map(inputs.REGION_ORDER).alias("counts"))
    asked = F.array(*[F.lit(r) for r in [*inputs.REGION_ORDER, "ATLANTIS"]])
    read = F.map_from_arrays(asked, F.transform(asked, lambda r: F.coalesce(F.try_element_at("counts", r), F.lit(0))))
    entries = counts.select("window_start", F.explode(read).alias("region", "n"))
    return entries.withColumn("n_plus", F.col("n") + 1)


@query(
    "json_extract",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(i AS INTEGER) AS position
    FROM (SELECT event_id, props, unnest([1, 2]) AS i FROM events)""",
)
def json_extract(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON record with a nested array (the event's properties twice), read with a schema and unnested."""
    doc = F.concat(F.lit('{"items":[{"position":1,"v":'), F.col("props"), F.lit('},{"position":2,"v":'), F.col("props"), F.lit("}]}"))
    schema = "items array<struct<position:int, v:struct<k:int>>>"
    read = inputs.events(spark, folder).select("event_id", F.from_json(doc, schema)["items"].alias("items"))
    return ops.unnest(read, "items").select("event_id", F.col("v.k").alias("k"), "position")


@query(
    "enrich_tier_weighted",
    """SELECT time_bucket(INTERVAL '1 day', o_orderdate) AS window_start, o_orderpriority,
      sum(CAST(round(o_totalprice * 100) AS BIGINT) * CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 150 WHEN 'BUILDING' THEN 120 ELSE 100 END)::BIGINT / 10000.0::DOUBLE AS weighted,
      count(*) AS n FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def enrich_tier_weighted(spark: SparkSession, folder: str) -> DataFrame:
    """Orders weighted by the customer tier's multiplier; a tier without one weighs 1.0."""
    orders = read_table(spark, folder, "orders", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = read_table(spark, folder, "customer", "c_custkey", "c_mktsegment")
    multipliers = spark.createDataFrame([("AUTOMOBILE", 150), ("BUILDING", 120)], "c_mktsegment string, percent int")
    tiered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    weighted = enrich(tiered, multipliers, "c_mktsegment", {"percent": 100})
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    daily = tumbling(
        weighted.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")),
        "o_orderdate",
        "1 day",
        ["o_orderpriority"],
        {"weighted": F.sum(cents * F.col("percent")) / F.lit(10000.0), "n": F.count(F.lit(1))},
    )
    return daily.drop("window_end")


@query(
    "lookup_async",
    f"WITH {ADM} SELECT event_id, hospital, region, capacity FROM adm",
)
def lookup_async_query(spark: SparkSession, folder: str) -> DataFrame:
    """The registry asked as an outside service, many calls in flight, answers as they come."""
    listed = {r["hospital"]: (r["region"], r["capacity"]) for r in inputs.registry(spark, folder).collect()}  # at most 25 rows
    rows = inputs.admissions(spark, folder).select("event_id", "hospital")

    def ask(part: pd.DataFrame, service: dict) -> pd.DataFrame:
        found = [service.get(name, (None, -1)) for name in part["hospital"]]
        return part.assign(region=[f[0] for f in found], capacity=[f[1] for f in found])

    return lookup_async(rows, ask, "event_id bigint, hospital string, region string, capacity int", open=lambda: listed, ordered=False, timeout=60.0, retries=1)
