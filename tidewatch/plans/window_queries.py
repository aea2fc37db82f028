"""Windows, aggregations, joins and key routing."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.registry import with_registry
from tidewatch.functions.user import aggregate_with, map_batches, window_rows_apply
from tidewatch.functions.user import window_apply as apply_to_windows
from tidewatch.operators import admissions as adm_ops
from tidewatch.operators import joins, keys, running, windows
from tidewatch.operators.rows import drop_faulty, split_words
from tidewatch.operators.timeline import Sample
from tidewatch.plans import inputs
from tidewatch.plans.catalog import query
from tidewatch.plans.inputs import ADM, EV, STAYED
from tidewatch.plans.row_queries import WORDS, faulty_readings
from tidewatch.plans.state_queries import discharges
from tidewatch.sources.tables import read_table

ROWS_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def n_rows() -> Column:
    return F.count(F.lit(1))


# ---- key routing ----


@query("key_partition", "SELECT event_id, user_id FROM events")
def key_partition(spark: SparkSession, folder: str) -> DataFrame:
    return keys.key_partition(inputs.events(spark, folder).select("event_id", "user_id"), "user_id")


@query("spread_partition", "SELECT event_id, user_id FROM events")
def spread_partition(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows with busy keys spread over several partitions."""
    rows = inputs.events(spark, folder).select("event_id", "user_id")
    return keys.spread_partition(rows, "user_id", row_id="event_id").drop("shard")


@query("sum_composite_key", f"WITH {ADM} SELECT region, event_type, sum(cents)::BIGINT AS cents FROM adm GROUP BY ALL")
def sum_composite_key(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.admissions(spark, folder).groupBy("region", "event_type").agg(F.sum("cents").alias("cents"))


@query(
    "skew_report",
    """WITH k AS (SELECT user_id, count(*) AS n FROM events GROUP BY ALL),
      w AS (SELECT CAST(CAST(concat('0x', substr(md5(CAST(user_id AS VARCHAR)), 1, 15)) AS BIGINT) % 8 AS INTEGER) AS worker,
        sum(n)::BIGINT AS records, count(*) AS distinct_keys FROM k GROUP BY ALL),
      t AS (SELECT sum(records)::DOUBLE AS r, sum(records * records)::DOUBLE AS q FROM w)
    SELECT worker, records, distinct_keys, sqrt(greatest(0.0::DOUBLE, q * 8 / (r * r) - 1) / 7.0::DOUBLE) * 100 AS skew_pct FROM w, t""",
)
def skew_report(spark: SparkSession, folder: str) -> DataFrame:
    return keys.skew_report(inputs.events(spark, folder), "user_id", 8)


@query("two_stage_total", f"WITH {EV} SELECT sum(cents)::BIGINT AS total, count(*) AS n_rows FROM ev")
def two_stage_total(spark: SparkSession, folder: str) -> DataFrame:
    return keys.two_stage_total(inputs.events(spark, folder), "cents", keys.worker_of("event_id", 64))


# ---- tumbling windows ----


@query(
    "total_count_window",
    """SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
      count(*) AS n FROM events GROUP BY ALL""",
)
def total_count_window(spark: SparkSession, folder: str) -> DataFrame:
    ones = inputs.events(spark, folder).select("ts", F.lit(1).cast("bigint").alias("one"))
    return windows.tumbling(ones, "ts", "1 hour", [], {"n": F.sum("one")})


@query(
    "word_count_window",
    "SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type AS word, count(*) AS n FROM events GROUP BY ALL",
)
def word_count_window(spark: SparkSession, folder: str) -> DataFrame:
    """Every record is one word, taken as it is."""
    words = inputs.events(spark, folder).select("ts", F.col("event_type").alias("word"), F.lit(1).cast("bigint").alias("one"))
    return windows.tumbling(words, "ts", "1 hour", ["word"], {"n": F.sum("one")}).drop("window_end")


REGIONAL = """SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
  region, sum(CASE WHEN value > 65 THEN 1 ELSE 0 END)::BIGINT AS n FROM adm"""


@query("regional_count", f"WITH {ADM} {REGIONAL} GROUP BY ALL")
def regional_count(spark: SparkSession, folder: str) -> DataFrame:
    return adm_ops.measure_by_region(
        inputs.admissions(spark, folder), "ts", "region", interval="1 hour", counted=[adm_ops.senior("value")]
    )


@query("regional_count_one", f"WITH {ADM} {REGIONAL} WHERE region = 'EUROPE' GROUP BY ALL")
def regional_count_one(spark: SparkSession, folder: str) -> DataFrame:
    return adm_ops.measure_by_region(
        inputs.admissions(spark, folder), "ts", "region", only="EUROPE", interval="1 hour", counted=[adm_ops.senior("value")]
    )


@query("conditional_count", f"WITH {ADM} SELECT hospital, count(*) FILTER (value > 65) AS n FROM adm GROUP BY ALL")
def conditional_count(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.admissions(spark, folder).groupBy("hospital").agg(adm_ops.count_where(adm_ops.senior("value")).alias("n"))


@query(
    "conditional_count_variants",
    f"""WITH {ADM} SELECT hospital, count(*) AS everyone, count(*) FILTER (value > 65) AS seniors,
      count(*) FILTER (value > 65) + count(*) FILTER (event_type = 'signup') AS seniors_and_women FROM adm GROUP BY ALL""",
)
def conditional_count_variants(spark: SparkSession, folder: str) -> DataFrame:
    """All, seniors, and seniors plus women on one counter (a senior woman counts twice)."""
    senior, woman = adm_ops.senior("value"), F.col("event_type") == "signup"
    return inputs.admissions(spark, folder).groupBy("hospital").agg(
        adm_ops.count_where(F.lit(True)).alias("everyone"),
        adm_ops.count_where(senior).alias("seniors"),
        adm_ops.count_where(senior, woman).alias("seniors_and_women"),
    )


_PER_REGION = ", ".join(f"count(*) FILTER (value > 65 AND region = '{r}') AS \"{r}\"" for r in inputs.REGION_ORDER)
_SHARES = ", ".join(
    f'CASE WHEN total > 0 THEN "{r}" * 100.0::DOUBLE / total ELSE 0.0::DOUBLE END AS "{r}_pct"' for r in inputs.REGION_ORDER
)


@query(
    "network_stats",
    f"""WITH {ADM}, t AS (SELECT time_bucket(INTERVAL '2 hours', ts) AS window_start, time_bucket(INTERVAL '2 hours', ts) + INTERVAL '2 hours' AS window_end,
      count(*) FILTER (value > 65) AS total, {_PER_REGION} FROM adm GROUP BY ALL) SELECT *, {_SHARES} FROM t""",
)
def network_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = adm_ops.measure_all_regions(
        inputs.admissions(spark, folder), "ts", "region", inputs.REGION_ORDER, "2 hours", [adm_ops.senior("value")]
    )
    return stats.withColumns({f"{r}_pct": adm_ops.share(F.col(r), F.col("total")) for r in inputs.REGION_ORDER})


@query(
    "avg_window",
    f"""WITH {EV} SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, user_id,
      coalesce(sum(cents) FILTER (event_type <> 'error')::DOUBLE / nullif(count(*) FILTER (event_type <> 'error'), 0) / 100.0::DOUBLE, 0.0::DOUBLE) AS average
    FROM ev GROUP BY ALL""",
)
def avg_window(spark: SparkSession, folder: str) -> DataFrame:
    """Average per key and day from a sum and a count; a window of only faulty readings gives 0.0."""
    good = F.when(F.col("event_type") != "error", F.col("cents"))
    average = F.coalesce(F.try_divide(F.sum(good), F.count(good)) / 100.0, F.lit(0.0))
    return windows.tumbling(inputs.events(spark, folder), "ts", "1 day", ["user_id"], {"average": average}).drop("window_end")


@query(
    "high_value_count",
    """SELECT time_bucket(INTERVAL '1 day', o_orderdate) AS window_start, o_orderpriority, count(*) FILTER (o_totalprice > 250000) AS n
    FROM orders GROUP BY ALL""",
)
def high_value_count(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders", "o_orderdate", "o_orderpriority", "o_totalprice")
    orders = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    large = F.count_if(F.col("o_totalprice") > 250000)
    return windows.tumbling(orders, "o_orderdate", "1 day", ["o_orderpriority"], {"n": large}).drop("window_end")


@query(
    "window_report",
    f"""WITH {EV}, w AS (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, user_id, count(*) AS n, sum(cents)::BIGINT AS s FROM ev GROUP BY ALL)
    SELECT window_start, user_id, concat('Window: ', strftime(window_start, '%H:%M:%S'), ' - ', strftime(window_start + INTERVAL '1 day', '%H:%M:%S'),
      ', count=', n, ', average=', CAST(floor(s::DOUBLE / n / 100 * 100 + 0.5) / 100 AS VARCHAR)) AS report FROM w""",
)
def window_report(spark: SparkSession, folder: str) -> DataFrame:
    """One text line per window and key, from running sums rather than the collected rows."""
    rows = windows.tumbling(inputs.events(spark, folder), "ts", "1 day", ["user_id"], {"n": n_rows(), "s": F.sum("cents")})
    average = F.floor(F.col("s").cast("double") / F.col("n") / 100 * 100 + 0.5) / 100
    report = F.concat(
        F.lit("Window: "), F.date_format("window_start", "HH:mm:ss"), F.lit(" - "), F.date_format("window_end", "HH:mm:ss"),
        F.lit(", count="), F.col("n").cast("string"), F.lit(", average="), average.cast("string"),
    )
    return rows.select("window_start", "user_id", report.alias("report"))


@query(
    "window_filter_rows",
    """SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, event_id, value
    FROM events WHERE value > 25""",
)
def window_filter_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of each window above 25: a filter and a window column, no grouping."""
    rows = inputs.events(spark, folder).where(F.col("value") > 25)
    start = windows.window_start("ts", "1 hour")
    return rows.select(
        start.alias("window_start"), windows.shift(start, windows.span_us("1 hour")).alias("window_end"), "event_id", "value"
    )


@query(
    "window_sum_report",
    f"""WITH {EV} SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, concat('Window total = ', sum(cents)::BIGINT) AS report
    FROM ev GROUP BY window_start""",
)
def window_sum_report(spark: SparkSession, folder: str) -> DataFrame:
    summed = windows.tumbling(inputs.events(spark, folder), "ts", "1 hour", [], {"s": F.sum("cents")})
    return summed.select("window_start", F.concat(F.lit("Window total = "), F.col("s").cast("string")).alias("report"))


# ---- sliding, session, top-k, early and late ----

SLIDING = f"""{EV}, sl AS (SELECT make_timestamp(epoch_us(time_bucket(INTERVAL '1 hour', ts)) - i * 3600000000) AS window_start, user_id,
    sum(cents)::BIGINT AS s, count(*) AS n FROM ev, (SELECT unnest(range(6)) AS i) WHERE event_type <> 'error' GROUP BY ALL),
  avgs AS (SELECT window_start, user_id, s::DOUBLE / n / 100 AS average FROM sl)"""


def sliding_averages(spark: SparkSession, folder: str) -> DataFrame:
    valid = drop_faulty(faulty_readings(spark, folder), "temperature")
    parts = {"s": ("sum", "cents"), "n": ("count", "cents")}
    slid = windows.sliding(valid, "ts", "6 hours", "1 hour", ["user_id"], parts)
    return slid.select("window_start", "user_id", (F.col("s").cast("double") / F.col("n") / 100).alias("average"))


@query("sliding_avg", f"WITH {SLIDING} SELECT window_start, user_id, average FROM avgs")
def sliding_avg(spark: SparkSession, folder: str) -> DataFrame:
    return sliding_averages(spark, folder)


@query(
    "sliding_cross_alert",
    f"""WITH {SLIDING} SELECT * FROM (SELECT window_start, user_id, average, lag(average) OVER (PARTITION BY user_id ORDER BY window_start) AS previous_value FROM avgs)
    WHERE average > 30 AND previous_value <= 30""",
)
def sliding_cross_alert(spark: SparkSession, folder: str) -> DataFrame:
    return windows.crossings(sliding_averages(spark, folder), ["user_id"], "window_start", "average", 30.0)


@query(
    "sessions",
    f"""WITH {EV}, m AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) <= 21600000000 THEN 0 ELSE 1 END AS opens FROM ev),
      g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts {ROWS_SO_FAR}) AS trip FROM m)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '6 hours' AS session_end, sum(cents)::DOUBLE / count(*) / 100 AS avg_speed,
      max(value) AS max_passengers, count(*) AS n FROM g GROUP BY user_id, trip""",
)
def sessions(spark: SparkSession, folder: str) -> DataFrame:
    aggs = {
        "avg_speed": F.sum("cents").cast("double") / n_rows() / 100,
        "max_passengers": F.max("value"),
        "n": n_rows(),
    }
    return windows.sessions(inputs.events(spark, folder), "ts", "6 hours", ["user_id"], aggs, ["event_id"])


@query(
    "topk_window",
    """SELECT * FROM (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, user_id, event_id, value,
      CAST(row_number() OVER (PARTITION BY time_bucket(INTERVAL '1 day', ts), user_id ORDER BY value DESC, event_id) AS INTEGER) AS rank FROM events) WHERE rank <= 3""",
)
def topk_window(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.events(spark, folder).select("event_id", "ts", "user_id", "value")
    return windows.top_k(rows, "ts", "1 day", ["user_id"], 3, "value", ["event_id"]).drop("ts")


@query(
    "topk_window_all",
    """SELECT * FROM (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, event_id, value,
      CAST(row_number() OVER (PARTITION BY time_bucket(INTERVAL '1 day', ts) ORDER BY value DESC, event_id) AS INTEGER) AS rank FROM events) WHERE rank <= 10""",
)
def topk_window_all(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.events(spark, folder).select("event_id", "ts", "value")
    return windows.top_k(rows, "ts", "1 day", [], 10, "value", ["event_id"]).drop("ts")


@query(
    "early_results",
    f"""WITH {ADM}, w AS (SELECT time_bucket(INTERVAL '6 hours', ts) AS window_start, region, min(time_bucket(INTERVAL '1 hour', ts)) + INTERVAL '1 hour' AS opening
        FROM adm GROUP BY ALL),
      m AS (SELECT window_start, region, unnest(generate_series(opening, window_start + INTERVAL '6 hours', INTERVAL '1 hour')) AS fire_time FROM w)
    SELECT m.window_start, m.region, m.fire_time, count(*) FILTER (a.value > 65) AS partial_count, m.fire_time = m.window_start + INTERVAL '6 hours' AS is_final
    FROM m JOIN adm a ON a.region IS NOT DISTINCT FROM m.region AND a.ts >= m.window_start AND a.ts < m.fire_time GROUP BY m.window_start, m.region, m.fire_time""",
)
def early_results(spark: SparkSession, folder: str) -> DataFrame:
    senior = F.when(adm_ops.senior("value"), F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return windows.early_counts(inputs.admissions(spark, folder), "ts", "6 hours", "1 hour", ["region"], senior)


@query(
    "early_fire",
    f"""WITH {ADM}, c AS (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, region, event_id, ts, row_number() OVER w AS fired_count, lead(event_id) OVER w IS NULL AS is_last
        FROM adm WINDOW w AS (PARTITION BY time_bucket(INTERVAL '1 day', ts), region ORDER BY ts, event_id))
    SELECT window_start, region, event_id, ts, fired_count, false AS is_final FROM c WHERE fired_count % 50 = 0
    UNION ALL SELECT window_start, region, event_id, ts, fired_count, true FROM c WHERE is_last""",
)
def early_fire(spark: SparkSession, folder: str) -> DataFrame:
    """A speculative result each time a window's count reaches another fifty, and the final one."""
    rows = inputs.admissions(spark, folder).select("event_id", "ts", "region")
    measure = inputs.admission_sample(spark, folder)
    return windows.fire_every_nth(rows, "ts", "1 day", ["region"], 50, ["event_id"], measure=measure)


SHIFTED_US = "CASE WHEN event_id % 10 = 0 THEN (300 + cents % 2400) * 10000000 ELSE 0 END"
LATE = f"""{EV}, arrived AS (SELECT event_id, epoch_us(ts) - {SHIFTED_US} AS us FROM ev),
  met AS (SELECT *, max(us) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 3600000000 AS mark, us - us % 3600000000 AS start_us FROM arrived),
  routed AS (SELECT event_id, make_timestamp(us) AS ts, make_timestamp(start_us) AS window_start,
    CASE WHEN mark IS NULL OR start_us + 3600000000 > mark THEN 'on_time' WHEN start_us + 3600000000 + 7200000000 > mark THEN 'refire' ELSE 'late' END AS route FROM met)"""


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Events in id order, every tenth one with an event time 50 minutes to 7.5 hours in the past."""
    rows = inputs.events(spark, folder)
    return rows.select("event_id", F.timestamp_micros(F.unix_micros("ts") - F.expr(SHIFTED_US)).alias("ts"))


@query("late_split", f"WITH {LATE} SELECT event_id, ts, window_start, route FROM routed")
def late_split(spark: SparkSession, folder: str) -> DataFrame:
    return windows.late_routes(arrivals(spark, folder), "ts", "event_id", "1 hour", "1 hour", "2 hours")


@query(
    "late_refires",
    f"""WITH {LATE} SELECT window_start, count(*) FILTER (route = 'on_time') AS first_count, count(*) FILTER (route <> 'late') AS final_count,
      count(*) FILTER (route = 'refire') AS refires, count(*) FILTER (route = 'late') AS late FROM routed GROUP BY ALL""",
)
def late_refires(spark: SparkSession, folder: str) -> DataFrame:
    """Per window: the count at its first firing, after all refirings, and the rows that came too late."""
    routed = windows.late_routes(arrivals(spark, folder), "ts", "event_id", "1 hour", "1 hour", "2 hours")
    route = F.col("route")
    return routed.groupBy("window_start").agg(
        F.count_if(route == "on_time").alias("first_count"),
        F.count_if(route != "late").alias("final_count"),
        F.count_if(route == "refire").alias("refires"),
        F.count_if(route == "late").alias("late"),
    )


# ---- running aggregates ----


@query(
    "running_total",
    f"""WITH {EV} SELECT event_id, user_id, sum(cents) OVER w::BIGINT AS running_total, count(*) OVER w AS running_count
    FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id {ROWS_SO_FAR})""",
)
def running_total(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.events(spark, folder).select("event_id", "ts", "user_id", "cents")
    return running.running(rows, ["user_id"], "ts", "cents", ["event_id"]).select(
        "event_id", "user_id", "running_total", "running_count"
    )


@query(
    "running_avg",
    f"""WITH {EV} SELECT event_id, event_type, sum(cents) OVER w::DOUBLE / count(*) OVER w AS running_avg
    FROM ev WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id {ROWS_SO_FAR})""",
)
def running_avg(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.events(spark, folder).select("event_id", "ts", "event_type", "cents")
    return running.running(rows, ["event_type"], "ts", "cents", ["event_id"]).select("event_id", "event_type", "running_avg")


@query(
    "word_count_running",
    f"""WITH {WORDS} SELECT doc_id, position, lower(word) AS word,
      count(*) OVER (PARTITION BY lower(word) ORDER BY doc_id, position {ROWS_SO_FAR}) AS running_count FROM words""",
)
def word_count_running(spark: SparkSession, folder: str) -> DataFrame:
    words = split_words(read_table(spark, folder, "documents", "doc_id", "text"), "text")
    words = words.withColumn("word", F.lower("word"))
    return running.running_count(words, ["word"], "doc_id", ["position"])


@query(
    "duration_stats",
    f"""WITH {STAYED} SELECT event_id, region, make_timestamp(due_us) AS due_time, count(*) OVER w AS n,
      sum(stay_ms) OVER w::DOUBLE / count(*) OVER w AS mean_value, max(stay_ms) OVER w AS max_value
    FROM stayed WHERE due_us <= (SELECT us FROM mark)
    WINDOW w AS (PARTITION BY region ORDER BY due_us, event_id {ROWS_SO_FAR})""",
)
def duration_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Count, mean and longest stay per region after every discharge."""
    done = discharges(spark, folder).withColumn("stay_ms", inputs.stay_ms())
    rows = done.select("event_id", "region", "due_time", "stay_ms")
    part = inputs.admission_sample(spark, folder)
    measure = Sample(discharges(spark, folder, part.rows), part.weight)
    return running.running_stats(rows, ["region"], "due_time", "stay_ms", ["event_id"], measure=measure).drop("stay_ms")


@query(
    "duration_stats_window",
    f"""WITH {STAYED} SELECT time_bucket(INTERVAL '1 day', make_timestamp(due_us)) AS window_start, region, count(*) AS n,
      sum(stay_ms)::DOUBLE / count(*) AS mean_value, max(stay_ms) AS max_value FROM stayed WHERE due_us <= (SELECT us FROM mark) GROUP BY ALL""",
)
def duration_stats_window(spark: SparkSession, folder: str) -> DataFrame:
    done = discharges(spark, folder).withColumn("stay_ms", inputs.stay_ms())
    aggs = {"n": n_rows(), "mean_value": F.sum("stay_ms").cast("double") / n_rows(), "max_value": F.max("stay_ms")}
    return windows.tumbling(done, "due_time", "1 day", ["region"], aggs).drop("window_end")


@query(
    "three_sigma",
    f"""WITH {EV}, b AS (SELECT event_id, user_id, cents::HUGEINT AS x, count(*) OVER w AS n, sum(cents) OVER w AS s, sum(cents * cents) OVER w AS q
      FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT event_id, user_id, n AS baseline_n, s::DOUBLE / nullif(n, 0) AS baseline_mean,
      coalesce(n >= 2 AND n * q > s * s AND (n * x - s) * (n * x - s) > 9 * (n * q - s * s), false) AS is_outlier FROM b""",
)
def three_sigma(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.events(spark, folder).select("event_id", "ts", "user_id", "cents")
    return running.baseline_outliers(rows, ["user_id"], "ts", "cents", ["event_id"]).drop("ts", "cents")


TTL = """{ev}, m AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < {gap} THEN 0 ELSE 1 END AS opens FROM ev),
  g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts {rows}) AS life FROM m),
  live AS (SELECT event_id, user_id, ts, sum(cents) OVER w::BIGINT AS live_sum, count(*) OVER w AS live_count FROM g
    WINDOW w AS (PARTITION BY user_id, life ORDER BY ts {rows}))"""


@query(
    "ttl_running_sum",
    f"""WITH {TTL.format(ev=EV, gap=24 * 3600 * 1000000, rows=ROWS_SO_FAR)}
    SELECT event_id, user_id, live_sum, live_sum > 10000 AS over_limit FROM live""",
)
def ttl_running_sum(spark: SparkSession, folder: str) -> DataFrame:
    """Spend since the account was last silent for a day, and whether it passes the limit."""
    rows = inputs.events(spark, folder).select("event_id", "ts", "user_id", "cents")
    spent = running.expiring_sum(rows, ["user_id"], "ts", "cents", "24 hours", ["event_id"])
    return spent.select("event_id", "user_id", "live_sum", (F.col("live_sum") > 10000).alias("over_limit"))


@query(
    "ttl_running_avg",
    f"""WITH {TTL.format(ev=EV, gap=6 * 3600 * 1000000, rows=ROWS_SO_FAR)}
    SELECT event_id, user_id, live_sum::DOUBLE / live_count AS live_avg FROM live""",
)
def ttl_running_avg(spark: SparkSession, folder: str) -> DataFrame:
    """Moving average that starts over after six hours without a reading."""
    rows = inputs.events(spark, folder).select("event_id", "ts", "user_id", "cents")
    live = running.expiring_sum(rows, ["user_id"], "ts", "cents", "6 hours", ["event_id"])
    return live.select("event_id", "user_id", (F.col("live_sum").cast("double") / F.col("live_count")).alias("live_avg"))


ROLLING = """SELECT event_id, user_id, sum(cents) OVER w::BIGINT AS rolling_sum, count(*) OVER w AS rolling_count
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '1 day' PRECEDING AND CURRENT ROW)"""


def rolling(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.events(spark, folder).select("event_id", "ts", "user_id", "cents")
    return windows.rolling_sum(rows, ["user_id"], "ts", "cents", "1 day", ["event_id"])


@query("rolling_sum_alert", f"WITH {EV} SELECT * FROM ({ROLLING}) WHERE rolling_sum > 15000")
def rolling_sum_alert(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts that moved more than the limit within one day."""
    alerts = rolling(spark, folder).where(F.col("rolling_sum") > 15000)
    return alerts.select("event_id", "user_id", "rolling_sum", "rolling_count")


@query("moving_avg", f"WITH {EV} SELECT event_id, user_id, rolling_sum::DOUBLE / rolling_count AS moving_avg FROM ({ROLLING})")
def moving_avg(spark: SparkSession, folder: str) -> DataFrame:
    average = F.col("rolling_sum").cast("double") / F.col("rolling_count")
    return rolling(spark, folder).select("event_id", "user_id", average.alias("moving_avg"))


# ---- joins ----


@query("lookup_registry", f"WITH {ADM} SELECT event_id, hospital, region, capacity FROM adm")
def lookup_registry(spark: SparkSession, folder: str) -> DataFrame:
    plain = inputs.admissions(spark, folder).drop("region", "capacity")
    looked_up = with_registry(plain, inputs.registry(spark, folder), "hospital", "region", "capacity")
    return looked_up.select("event_id", "hospital", "region", "capacity")


def _side(spark: SparkSession, folder: str, kind: str, prefix: str) -> DataFrame:
    rows = inputs.events(spark, folder).where(F.col("event_type") == kind)
    return rows.select(
        "user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"),
        F.col("cents").alias(f"{prefix}_cents"), F.col("props").alias(f"{prefix}_props"),
    )


_PAIR = """(SELECT user_id, event_id AS purchase_id, ts AS purchase_ts, cents AS purchase_cents, time_bucket(INTERVAL '1 day', ts) AS window_start
    FROM ev WHERE event_type = 'purchase') a {how} JOIN
  (SELECT user_id, event_id AS view_id, ts AS view_ts, cents AS view_cents, time_bucket(INTERVAL '1 day', ts) AS window_start
    FROM ev WHERE event_type = 'view') b USING (user_id, window_start)"""


def _window_pairs(spark: SparkSession, folder: str, how: str) -> DataFrame:
    purchases = _side(spark, folder, "purchase", "purchase").drop("purchase_props")
    views = _side(spark, folder, "view", "view").drop("view_props")
    return joins.window_join(purchases, views, ["user_id"], "purchase_ts", "view_ts", "1 day", how)


@query("window_join", f"WITH {EV} SELECT user_id, window_start, purchase_id, view_id FROM {_PAIR.format(how='')}")
def window_join(spark: SparkSession, folder: str) -> DataFrame:
    return _window_pairs(spark, folder, "inner").select("user_id", "window_start", "purchase_id", "view_id")


@query(
    "window_join_convert",
    f"WITH {EV} SELECT purchase_id, view_id, purchase_cents * view_cents AS converted FROM {_PAIR.format(how='')}",
)
def window_join_convert(spark: SparkSession, folder: str) -> DataFrame:
    """Each amount times each rate of its window."""
    pairs = _window_pairs(spark, folder, "inner")
    return pairs.select("purchase_id", "view_id", (F.col("purchase_cents") * F.col("view_cents")).alias("converted"))


@query("window_outer_join", f"WITH {EV} SELECT user_id, window_start, purchase_id, view_id FROM {_PAIR.format(how='FULL')}")
def window_outer_join(spark: SparkSession, folder: str) -> DataFrame:
    return _window_pairs(spark, folder, "full").select("user_id", "window_start", "purchase_id", "view_id")


_INTERVAL = """FROM (SELECT user_id, event_id AS purchase_id, ts AS out_ts, props AS p1 FROM events WHERE event_type = 'purchase') a {how} JOIN
  (SELECT user_id AS u2, event_id AS signup_id, ts AS back_ts, props AS p2 FROM events WHERE event_type = 'signup') b
  ON user_id = u2 AND back_ts BETWEEN out_ts AND out_ts + INTERVAL '6 hours'"""


def _readmissions(spark: SparkSession, folder: str, how: str) -> DataFrame:
    out = _side(spark, folder, "purchase", "purchase").drop("purchase_cents")
    back = _side(spark, folder, "signup", "signup").drop("signup_cents")
    return joins.interval_join(out, back, ["user_id"], "purchase_ts", "signup_ts", "0 seconds", "6 hours", how)


@query("interval_join", f"SELECT user_id, purchase_id, signup_id, p1 = p2 AS same {_INTERVAL.format(how='')}")
def interval_join(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _readmissions(spark, folder, "inner")
    return pairs.select("user_id", "purchase_id", "signup_id", (F.col("purchase_props") == F.col("signup_props")).alias("same"))


@query("interval_left_join", f"SELECT user_id, purchase_id, signup_id {_INTERVAL.format(how='LEFT')}")
def interval_left_join(spark: SparkSession, folder: str) -> DataFrame:
    return _readmissions(spark, folder, "left").select("user_id", "purchase_id", "signup_id")


# ---- user-defined functions ----


@query(
    "udaf_avg",
    f"WITH {EV} SELECT event_type, sum(cents)::DOUBLE / count(*) AS average, count(*) AS n FROM ev GROUP BY ALL",
)
def udaf_avg(spark: SparkSession, folder: str) -> DataFrame:
    """A user accumulator in Python: partial per task, merged per key."""
    def add(rows: pd.DataFrame) -> dict:
        return {"s": int(rows["cents"].sum()), "n": len(rows)}

    def merge(a: dict, b: dict) -> dict:
        return {"s": a["s"] + b["s"], "n": a["n"] + b["n"]}

    def result(acc: dict) -> dict:
        return {"average": acc["s"] / acc["n"], "n": acc["n"]}

    rows = inputs.events(spark, folder).select("event_type", "cents")
    return aggregate_with(rows, "event_type", {"s": "bigint", "n": "bigint"}, add, merge, result, {"average": "double", "n": "bigint"})


@query(
    "udtf_warnings",
    """SELECT user_id, event_id, 'warm' AS level, value FROM events WHERE event_type <> 'error' AND value >= 28
    UNION ALL SELECT user_id, event_id, 'hot', value FROM events WHERE event_type <> 'error' AND value > 32""",
)
def udtf_warnings(spark: SparkSession, folder: str) -> DataFrame:
    """The free-form door: a user flatMap over Arrow batches."""
    valid = drop_faulty(faulty_readings(spark, folder), "temperature").select("user_id", "event_id", "value")

    def warn(readings: pd.DataFrame) -> pd.DataFrame:
        warm = readings[readings["value"] >= 28].assign(level="warm")
        hot = readings[readings["value"] > 32].assign(level="hot")
        return pd.concat([warm, hot])[["user_id", "event_id", "level", "value"]]

    return map_batches(valid, warn, "user_id bigint, event_id bigint, level string, value double")


@query(
    "window_apply",
    f"""WITH {EV}, w AS (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, user_id, sum(cents)::BIGINT AS s, count(*) AS n FROM ev GROUP BY ALL)
    SELECT window_start, user_id, concat(user_id, ' average = ', CAST((s // n) AS VARCHAR), ' cents') AS line FROM w""",
)
def window_apply(spark: SparkSession, folder: str) -> DataFrame:
    """A user window function that gets the window's pre-aggregated row, bounds and key."""

    def describe(sums: pd.DataFrame) -> pd.DataFrame:
        average = (sums["s"] // sums["n"]).astype(str)
        return sums[["window_start", "user_id"]].assign(line=sums["user_id"].astype(str) + " average = " + average + " cents")

    aggs = {"s": F.sum("cents"), "n": n_rows()}
    return apply_to_windows(inputs.events(spark, folder), "ts", "1 day", ["user_id"], aggs, describe, "window_start timestamp, user_id bigint, line string")


@query(
    "window_rows_median",
    f"""WITH {EV} SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, event_type, count(*) AS n, quantile_cont(cents, 0.5)::DOUBLE AS median_cents,
      max(cents) - min(cents) AS spread FROM ev GROUP BY ALL""",
)
def window_rows_median(spark: SparkSession, folder: str) -> DataFrame:
    """A full-window function per key and day: rows come ordered by value, and only those from the middle on are held."""

    def summarise(window: dict, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: deque = deque()  # pieces from the lower middle on
        n = dropped = 0
        for part in rows:
            values = part["cents"].to_numpy()
            lowest = values[0] if not n else lowest
            held.append(values)
            n += len(values)
            while dropped + len(held[0]) <= (n - 1) // 2:
                dropped += len(held.popleft())
        middle = np.concatenate(held)
        a, b = ((n - 1) // 2 - dropped, n // 2 - dropped)
        median = (int(middle[a]) + int(middle[b])) / 2
        yield pd.DataFrame([{"window_start": window["window_start"], "event_type": window["event_type"], "n": n, "median_cents": median, "spread": middle[-1] - lowest}])

    schema = "window_start timestamp, event_type string, n bigint, median_cents double, spread bigint"
    return window_rows_apply(inputs.events(spark, folder), "ts", "1 day", ["event_type"], summarise, schema, ["cents"])


@query(
    "window_rows_pairs",
    f"""WITH {EV}, p AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_id, cents, lag(event_id) OVER w AS before_id, lag(cents) OVER w AS before_cents FROM ev
      WINDOW w AS (PARTITION BY time_bucket(INTERVAL '1 hour', ts) ORDER BY ts, event_id))
    SELECT window_start, before_id, event_id, before_cents - cents AS fall FROM p WHERE before_cents - cents > 5000""",
)
def window_rows_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """A full-window function over all rows of an hour, with no or many outputs: neighbours of which the second is far lower."""

    def falls(window: dict, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for part in rows:
            part = part[["event_id", "cents"]]
            joined = part if last is None else pd.concat([last, part], ignore_index=True)
            before = joined.shift()
            fall = before["cents"] - joined["cents"]
            low = fall > 5000
            if low.any():
                yield pd.DataFrame({"window_start": window["window_start"], "before_id": before["event_id"][low].astype("int64"), "event_id": joined["event_id"][low], "fall": fall[low].astype("int64")})
            last = part.tail(1)

    schema = "window_start timestamp, before_id bigint, event_id bigint, fall bigint"
    return window_rows_apply(inputs.events(spark, folder), "ts", "1 hour", [], falls, schema, ["ts", "event_id"])
