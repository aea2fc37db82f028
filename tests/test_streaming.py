"""Every streaming form gives the rows of its batch form, for any cut of the input into files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from streams import HEARTBEAT_USER, drain, event_files, values
from tidewatch.functions import news2
from tidewatch.operators import admissions as adm_ops
from tidewatch.operators import detect, joins, occupancy, paging, rules, running, vitals, windows
from tidewatch.sources.tables import read_events
from tidewatch.streaming import pipelines

HOUR_US = 3_600_000_000
MS = "1 millisecond"


@pytest.fixture(scope="module")
def feed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("feed")
    return event_files(SMALL, str(folder))


@pytest.fixture(scope="module")
def mixed_feed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("mixed")
    return event_files(SMALL, str(folder), disorder_ms=6 * 3_600_000)


def stream(spark, feed, delay=MS):
    return prepared(read_events(spark, feed, stream=True, delay=delay, files_per_trigger=1))


def batch(spark, feed):
    return prepared(read_events(spark, feed))


def prepared(rows):
    hospital = F.concat(F.lit("H"), (F.col("user_id") % 4).cast("string"))
    return rows.withColumns(
        {
            "cents": F.round(F.col("value") * 100).cast("bigint"),
            "hospital": hospital,
            "region": F.when(hospital == "H3", "S").otherwise("N"),
            "capacity": F.when(hospital == "H2", -1).otherwise(60).cast("int"),
        }
    )


def real(df):
    return df.where(F.col("user_id") != HEARTBEAT_USER)


def until(rows):
    return occupancy.closed_until(rows, "ts")


def test_tumbling(spark, feed, scratch):
    def counted(rows):
        return adm_ops.measure_by_region(rows, "ts", "region", interval="6 hours", counted=[adm_ops.senior("value")])

    ours = drain(counted(stream(spark, feed)), "tumbling", scratch)
    closed = counted(batch(spark, feed)).where(F.unix_micros("window_end") <= until(batch(spark, feed)))
    columns = ("window_start", "window_end", "region", "n")
    assert values(ours, *columns) == values(closed, *columns)


def test_tumbling_out_of_order(spark, mixed_feed, scratch):
    def counted(rows):
        return windows.tumbling(rows, "ts", "6 hours", ["user_id"], {"s": F.sum("cents"), "n": F.count("cents")})

    ours = drain(counted(stream(spark, mixed_feed, "6 hours")), "tumbling_mixed", scratch)
    expected = real(counted(batch(spark, mixed_feed)))
    columns = ("window_start", "user_id", "s", "n")
    assert values(real(ours), *columns) == values(expected, *columns)


def test_sliding(spark, feed, scratch):
    parts = {"s": ("sum", "cents"), "n": ("count", "cents"), "hi": ("max", "cents")}
    ours = drain(windows.sliding(stream(spark, feed), "ts", "6 hours", "1 hour", ["user_id"], parts), "sliding", scratch)
    panes = windows.sliding(batch(spark, feed), "ts", "6 hours", "1 hour", ["user_id"], parts)
    columns = ("window_start", "window_end", "user_id", "s", "n", "hi")
    assert values(real(ours), *columns) == values(real(panes), *columns)


def test_sessions(spark, feed, scratch):
    def aggs():
        return {"s": F.sum("cents"), "n": F.count("cents")}

    ours = drain(windows.sessions(stream(spark, feed), "ts", "12 hours", ["user_id"], aggs()), "sessions", scratch)
    expected = windows.sessions(batch(spark, feed), "ts", "12 hours", ["user_id"], aggs(), ["event_id"])
    columns = ("session_start", "session_end", "user_id", "s", "n")
    assert values(real(ours), *columns) == values(real(expected), *columns)


def sides(rows):
    left = rows.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("a"), F.col("ts").alias("a_ts"))
    right = rows.where("event_type = 'view'").select("user_id", F.col("event_id").alias("b"), F.col("ts").alias("b_ts"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
def test_window_join(spark, feed, scratch, how):
    a, _ = sides(stream(spark, feed))
    _, b = sides(stream(spark, feed))
    ours = drain(joins.window_join(a, b, ["user_id"], "a_ts", "b_ts", "1 day", how), f"window_join_{how}", scratch)
    expected = joins.window_join(*sides(batch(spark, feed)), ["user_id"], "a_ts", "b_ts", "1 day", how)
    inner = values(expected.where("b is not null"), "user_id", "a", "b")
    assert values(ours.where("b is not null"), "user_id", "a", "b") == inner
    assert set(values(ours, "user_id", "a", "b")) <= set(values(expected, "user_id", "a", "b"))


def test_interval_join(spark, feed, scratch):
    a, _ = sides(stream(spark, feed))
    _, b = sides(stream(spark, feed))
    ours = drain(joins.interval_join(a, b, ["user_id"], "a_ts", "b_ts", "0 seconds", "12 hours"), "interval", scratch)
    expected = joins.interval_join(*sides(batch(spark, feed)), ["user_id"], "a_ts", "b_ts", "0 seconds", "12 hours")
    assert values(ours, "user_id", "a", "b") == values(expected, "user_id", "a", "b")


def test_capacity_alert_forwards_everything(spark, feed, scratch):
    tagged = drain(
        pipelines.capacity_alerts(stream(spark, feed), "hospital", "ts", "capacity", "event_id"), "capacity", scratch
    )
    rows = batch(spark, feed)
    assert tagged.where("tag = 'main'").count() == rows.count()
    expected = occupancy.capacity_alerts(rows, "hospital", "ts", "capacity", ["event_id"])
    ours = tagged.where("tag = 'alert'").select("hospital", F.col("tie").alias("event_id"), "occupied")
    assert values(ours, "hospital", "event_id", "occupied") == values(expected, "hospital", "event_id", "occupied")
    assert expected.count() == 3


STAY = 5 * 24 * 3_600_000


def stay():
    return F.lit(STAY) + (F.col("cents") % 100) * 3_600_000


def test_deferred_emit(spark, feed, scratch):
    ours = drain(pipelines.deferred_emit(stream(spark, feed), "user_id", "ts", stay(), ["event_id", "hospital"], "1 day"), "deferred", scratch)
    expected = occupancy.deferred_emit(batch(spark, feed), "ts", stay(), until(batch(spark, feed)))
    columns = ("user_id", "event_id", "hospital", "due_time")
    assert values(real(ours), *columns) == values(real(expected), *columns)


def test_deferred_emit_spread_over_shards(spark, feed, scratch):
    out = pipelines.deferred_emit(stream(spark, feed), "hospital", "ts", stay(), ["event_id", "user_id"], "1 hour", spread="event_id", shards=3)
    ours = drain(out, "deferred_shards", scratch)
    expected = occupancy.deferred_emit(batch(spark, feed), "ts", stay(), until(batch(spark, feed)))
    columns = ("hospital", "event_id", "due_time")
    assert values(real(ours), *columns) == values(real(expected), *columns) and set(ours.columns) == {"event_id", "user_id", "hospital", "due_time"}


def test_deferred_slot_overwrites(spark, feed, scratch):
    ours = drain(pipelines.deferred_slot(stream(spark, feed), "user_id", "ts", stay(), ["event_id"]), "slot", scratch)
    rows = batch(spark, feed).select("user_id", "event_id", "ts", "cents")
    expected = occupancy.deferred_emit_single(rows, ["user_id"], "ts", stay(), ["event_id"], until(rows))
    # the stream's slot is overwritten by a whole micro-batch before its timers run
    assert set(r[1] for r in values(real(ours), "user_id", "event_id")) <= set(r["event_id"] for r in rows.collect())
    assert real(ours).count() <= expected.count()


@pytest.mark.parametrize("which, slot", [("feed", "1 minute"), ("mixed_feed", "1 day")])
def test_occupancy_alerts(spark, request, scratch, which, slot):
    feed = request.getfixturevalue(which)
    delay = MS if which == "feed" else "6 hours"
    rows = batch(spark, feed).where("region is not null")
    ours = drain(
        pipelines.occupancy_alerts(stream(spark, feed, delay), "hospital", "ts", stay(), "capacity", "region", "event_id", slot),
        f"beds_{which}", scratch,
    )
    steps = occupancy.stay_steps(rows, ["hospital", "region", "capacity", "event_id"], "ts", stay())
    expected = occupancy.occupancy_alerts(steps, "hospital", "ts", "delta", "capacity", ["event_id"]).withColumnRenamed("event_id", "tie")
    last = rows.where(F.col("user_id") != HEARTBEAT_USER).agg(F.max("ts")).first()[0]
    columns = ("hospital", "ts", "tie", "previous_status", "status", "occupied", "occupancy_pct")
    got = values(ours.where(F.col("ts") <= last), *columns)
    assert got == values(expected.where(F.col("ts") <= last), *columns)
    assert got


def test_silence(spark, feed, scratch):
    ours = drain(pipelines.silence_resume(stream(spark, feed), "user_id", "ts", "12 hours"), "silence", scratch)
    rows = batch(spark, feed)
    expected = detect.silence_resume(rows, ["user_id"], "ts", "12 hours", until(rows), ["event_id"])
    columns = ("user_id", "alert", "alert_time")
    assert values(real(ours), *columns) == values(real(expected), *columns)


def test_sustained_breach(spark, mixed_feed, scratch):
    ours = drain(
        pipelines.sustained_breach(stream(spark, mixed_feed, "6 hours"), "user_id", "ts", F.col("value") > 30, "6 hours", "event_id", "5 hours"),
        "breach", scratch,
    )
    rows = batch(spark, mixed_feed)
    expected = detect.sustained_breach(rows, ["user_id"], "ts", F.col("value") > 30, 6 * HOUR_US, until(rows), ["event_id"])
    columns = ("user_id", "breach_start", "alert_time")
    assert values(real(ours), *columns) == values(real(expected), *columns)
    assert expected.count() > 20


def coded(rows):
    code = F.element_at(F.array(*[F.lit(c) for c in news2.VITALS]), (F.col("event_id") % 7 + 1).cast("int"))
    value = F.when(code == "TEMP", 34.0 + F.col("cents") % 6).otherwise(F.col("cents") % 120).cast("double")
    return rows.withColumns({"code": code, "v": value})


def test_news2(spark, feed, scratch):
    ours = drain(
        pipelines.news2_scores(coded(stream(spark, feed)), "user_id", "ts", "code", "v", "event_id", "5 days", "1 day", "9 days", "2 days"),
        "news2", scratch,
    )
    rows = coded(batch(spark, feed))
    scores = vitals.news2_changes(rows, "user_id", "ts", "code", "v", ["event_id"], "5 days")
    columns = ("user_id", "ts", "total", "band", *[f"{code.lower()}_points" for code in news2.VITALS])
    got = values(real(ours).where("tag = 'score'"), *columns)
    assert got == values(real(scores), *columns)
    assert len(got) > 50
    notices = vitals.news2_unavailable(rows, "user_id", "ts", "code", "v", ["event_id"], "5 days", "1 day")
    columns = ("user_id", "ts", "missing")
    assert values(real(ours).where("tag = 'unavailable'"), *columns) == values(real(notices), *columns)


def test_pages(spark, feed, scratch):
    def alerts(rows):
        return rows.withColumn("shard", F.pmod(F.col("user_id"), F.lit(2))).where("value > 40 or user_id < 0")

    who = F.concat_ws("|", F.col("user_id").cast("string"), F.col("event_type"))
    ours = drain(
        pipelines.pages(alerts(stream(spark, feed)), "shard", "ts", who, F.col("value") > 150, "event_id", "1 day", 10, "7 hours"), "pages", scratch
    )
    kept = paging.suppress_repeats(
        alerts(batch(spark, feed)).withColumn("who", who).select("event_id", "ts", "who", "shard", "value", "user_id"), ["who"], "ts", "1 day", ["event_id"]
    )
    expected = paging.page_batches(real(kept), ["shard"], "ts", F.col("value") > 150, ["event_id"])
    pages = ours.groupBy("shard", "page").agg(F.count("tie").alias("alerts"), F.max("ts").alias("flushed_at"))
    last = real(batch(spark, feed)).agg(F.max("ts")).first()[0]
    columns = ("shard", "alerts", "flushed_at")
    assert values(pages.where(F.col("flushed_at") <= last), *columns) == values(expected, *columns)


def test_expiring_sum(spark, feed, scratch):
    ours = drain(pipelines.expiring_sum(stream(spark, feed), "user_id", "ts", "cents", "12 hours", "event_id", "1 day"), "expiring", scratch)
    expected = running.expiring_sum(
        batch(spark, feed).select("user_id", "event_id", "ts", "cents"), ["user_id"], "ts", "cents", "12 hours", ["event_id"]
    ).withColumnRenamed("event_id", "tie")
    columns = ("user_id", "tie", "live_sum", "live_count")
    assert values(real(ours), *columns) == values(real(expected), *columns)


def test_baseline_outliers(spark, feed, scratch):
    ours = drain(pipelines.baseline_outliers(stream(spark, feed), "user_id", "ts", "cents", "event_id", slot="3 days"), "baseline", scratch)
    expected = running.baseline_outliers(
        batch(spark, feed).select("user_id", "event_id", "ts", "cents"), ["user_id"], "ts", "cents", ["event_id"]
    ).withColumnRenamed("event_id", "tie")
    columns = ("user_id", "tie", "baseline_n", "is_outlier")
    assert values(real(ours), *columns) == values(real(expected), *columns)


def test_early_fire(spark, feed, scratch):
    ours = drain(pipelines.early_fire(stream(spark, feed), "event_type", "ts", "7 days", 20), "early", scratch)
    fired = windows.fire_every_nth(batch(spark, feed), "ts", "7 days", ["event_type"], 20, ["event_id"])
    early = ours.where("not is_final and event_type <> 'beat'").withColumnRenamed("n", "fired_count")
    columns = ("event_type", "window_start", "fired_count")
    assert values(early, *columns) == values(fired.where("not is_final"), *columns)
    last = fired.where("is_final").withColumnRenamed("fired_count", "n")
    assert values(ours.where("is_final and event_type <> 'beat'"), "event_type", "window_start", "n") == values(last.where("event_type <> 'beat'"), "event_type", "window_start", "n")
    final = ours.where("is_final and event_type <> 'beat'")
    totals = windows.tumbling(batch(spark, feed).where("event_type <> 'beat'"), "ts", "7 days", ["event_type"], {"n": F.count("ts")})
    assert values(final, "event_type", "window_start", "n") == values(totals, "event_type", "window_start", "n")


def test_sliding_crossings(spark, feed, scratch):
    ours = drain(
        pipelines.sliding_crossings(stream(spark, feed), "user_id", "ts", "1 day", "6 hours", "cents", 3000.0), "crossings", scratch
    )
    slid = windows.sliding(batch(spark, feed), "ts", "1 day", "6 hours", ["user_id"], {"s": ("sum", "cents"), "n": ("count", "cents")})
    averages = slid.withColumn("x", F.col("s").cast("double") / F.col("n"))
    expected = windows.crossings(averages, ["user_id"], "window_start", "x", 3000.0)
    columns = ("user_id", "window_start", "x", "previous_value")
    assert values(real(ours), *columns) == values(real(expected), *columns)


def test_late_rows_go_to_the_side(spark, scratch, tmp_path):
    import pandas as pd

    from streams import write

    def part(name, minutes):
        at = [pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=m) for m in minutes]
        write(
            pd.DataFrame({"event_id": minutes, "ts": at, "user_id": 1, "event_type": "x", "value": 1.0, "props": "{}"}),
            f"{tmp_path}/{name}.parquet",
        )

    part("a", [5, 15, 40])
    part("b", [6, 27, 29, 100])
    part("c", [7, 91])
    rows = read_events(spark, str(tmp_path), stream=True, delay="3 hours", files_per_trigger=1)
    out = pipelines.late_routes(rows, "user_id", "ts", "10 minutes", "5 minutes", "30 minutes", "3 hours", "event_id")
    got = dict(values(drain(out, "late", scratch), "tie", "route"))
    # after file a the logical watermark is 35, after file b it is 95
    assert got == {5: "on_time", 15: "on_time", 40: "on_time", 6: "refire", 27: "refire", 29: "refire", 100: "on_time", 7: "late", 91: "on_time"}


def closed(ts, slower, delay):
    """Whether a time is behind the watermark of two inputs, of which ``slower`` ends first."""
    behind = windows.span_us(delay)
    mark = occupancy.closed_until(slower, "ts", behind) // 1000 * 1000
    return F.unix_micros(ts) <= mark


def sized(rows):
    """Every ninth event sets its hospital's capacity, sometimes to nothing."""
    size = F.when(F.col("event_id") % 63 == 0, 0).otherwise(20 + F.col("event_id") % 50).cast("int")
    return rows.where("event_id % 9 = 0").select("hospital", "ts", size.alias("capacity"), "event_id", "user_id")


@pytest.mark.parametrize("which, slot", [("feed", "1 hour"), ("mixed_feed", "1 millisecond")])
def test_dynamic_capacity(spark, request, scratch, which, slot):
    feed = request.getfixturevalue(which)
    delay = MS if which == "feed" else "6 hours"
    admitted, updates = stream(spark, feed, delay), sized(stream(spark, feed, delay))
    ours = drain(pipelines.dynamic_capacity(admitted, updates, "hospital", "ts", stay(), "capacity", "event_id", slot), f"sized_{which}", scratch)
    rows = batch(spark, feed)
    steps = occupancy.stay_steps(rows, ["hospital", "event_id"], "ts", stay())
    expected = occupancy.dynamic_capacity(steps.withColumn("capacity", F.lit(0)), sized(rows).drop("user_id"), "hospital", "ts", "delta", "capacity", ["event_id"])
    columns = ("hospital", "ts", "event_id", "previous_status", "status", "occupied", "capacity", "occupancy_pct")
    got = values(ours.withColumnRenamed("tie", "event_id"), *columns)
    assert got == values(expected.where(closed("ts", sized(rows), delay)), *columns) and len(got) > 50
    # a capacity update alone changes the status
    at_update = ours.join(sized(rows).select("hospital", "ts", F.col("event_id").alias("tie")), ["hospital", "ts", "tie"], "left_semi")
    assert at_update.count() > 5


def test_dynamic_capacity_waits_for_the_slower_input(spark, feed, scratch):
    updates = sized(stream(spark, feed)).where("user_id >= 0")
    middle = real(batch(spark, feed)).agg(F.expr("timestamp_micros(cast(avg(unix_micros(ts)) as bigint))")).first()[0]
    cut = read_events(spark, feed, stream=True, files_per_trigger=1).where(F.col("ts") < F.lit(middle)).withWatermark("ts", MS)
    ours = drain(pipelines.dynamic_capacity(prepared(cut), updates, "hospital", "ts", stay(), "capacity", "event_id", "1 hour"), "slower", scratch)
    assert ours.count() and ours.agg(F.max("ts")).first()[0] < middle


def commanded(rows):
    """Rules of each event type, set and deleted by events, and care plans of some patients."""
    eighth = F.col("event_id") % 8
    kind = F.when(F.col("event_id") % 5 == 0, "CAREPLAN").otherwise("RULE")
    ward = F.when(eighth % 3 == 0, rules.ANY_WARD).when(eighth % 3 == 1, "ICU-A").otherwise("ICU-B")
    return rows.where("event_id % 6 = 1").select(
        "ts", "event_id", kind.alias("kind"), F.when(F.col("event_id") % 4 == 3, "DELETE").otherwise("UPSERT").alias("op"),
        F.when(kind == "RULE", F.concat_ws("-", "event_type", eighth.cast("string"))).alias("ruleId"), ward.alias("wardId"), F.col("event_type").alias("vitalCode"),
        F.concat(F.lit("P-"), F.col("user_id").cast("string")).alias("patientId"), F.lit(1.0).alias("min"), (F.col("value") / 2).alias("max"),
        (F.col("event_id") % 7 * 36_000).cast("int").alias("sustainSeconds"), F.lit("LOW").alias("severity"),
    )


def read_wards(rows):
    ward = F.when(F.col("user_id") % 2 == 0, "ICU-A").otherwise("ICU-B")
    patient = F.concat(F.lit("P-"), F.col("user_id").cast("string"))
    return rows.select("event_id", "ts", patient.alias("patientId"), ward.alias("wardId"), F.col("event_type").alias("vitalCode"), "value")


DEFAULTS = [("DEFAULT", "*", "view", 5.0, 40.0, 7200, "LOW")]


@pytest.mark.parametrize("which, shards", [("feed", 3), ("mixed_feed", 1)])
def test_live_rules(spark, request, scratch, which, shards):
    feed = request.getfixturevalue(which)
    delay = MS if which == "feed" else "6 hours"
    watched = pipelines.rule_monitor(read_wards(stream(spark, feed, delay)), commanded(stream(spark, feed, delay)), "ts", "event_id", DEFAULTS, shards, slot="1 hour")
    ours = drain(watched, f"rules_{which}", scratch)
    rows = batch(spark, feed)
    commands = commanded(rows)
    versions = rules.versions(commands.where("kind = 'RULE'"), ["ruleId"], "ts", rules.RULE_FIELDS, ["event_id"])
    held = spark.createDataFrame(DEFAULTS, "ruleId string, wardId string, vitalCode string, min double, max double, sustainSeconds int, severity string")
    plans = rules.versions(commands.where("kind = 'CAREPLAN'"), ["patientId", "vitalCode"], "ts", ["min", "max"], ["event_id"])
    planned = rules.with_care_plan(rules.match_rules(read_wards(rows), rules.rule_set(versions, held), "ts"), plans, "ts")
    columns = ("event_id", "patientId", "ruleId", "value", "by_plan", "tag")
    routed = planned.where("route <> 'ok'").where(closed("ts", commands, delay)).withColumnRenamed("route", "tag")
    got = values(ours.where("tag <> 'sustained'"), *columns)
    assert got == values(routed, *columns) and len({r[-1] for r in got}) == 2
    sustained = rules.sustained_rule_breach(planned, "ts", until(rows), ["event_id"])
    columns = ("patientId", "ruleId", "breach_start", "alert_time", "by_plan")
    got = values(ours.where("tag = 'sustained'"), *columns)
    assert got == values(sustained.where(closed("alert_time", commands, delay)), *columns) and len(got) > 10


def test_a_delete_ends_the_episode(spark, scratch, tmp_path):
    import pandas as pd

    from streams import write

    at = [pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=m) for m in (0, 1, 2, 5, 6, 30, 90)]
    kinds = ["set", "read", "read", "delete", "set", "read", "beat"]
    write(pd.DataFrame({"event_id": range(7), "ts": at, "user_id": 1, "event_type": kinds, "value": 9.0, "props": "{}"}), f"{tmp_path}/a.parquet")
    rows = read_events(spark, str(tmp_path), stream=True, delay=MS)
    readings = rows.where("event_type in ('read', 'beat')").select("event_id", "ts", F.lit("P").alias("patientId"), F.lit("W").alias("wardId"), F.when(F.col("event_type") == "read", "HR").alias("vitalCode"), "value")
    commands = rows.where("event_type not in ('read')").select(
        "ts", "event_id", F.when(F.col("event_type") == "beat", "BEAT").otherwise("RULE").alias("kind"), F.when(F.col("event_type") == "delete", "DELETE").otherwise("UPSERT").alias("op"),
        F.lit("R").alias("ruleId"), F.lit("*").alias("wardId"), F.lit("HR").alias("vitalCode"), F.lit(None).cast("string").alias("patientId"),
        F.lit(0.0).alias("min"), F.lit(5.0).alias("max"), F.lit(600).alias("sustainSeconds"), F.lit("LOW").alias("severity"),
    )
    ours = drain(pipelines.rule_monitor(readings, commands, "ts", "event_id", (), 2, slot="1 minute"), "deleted", scratch)
    sustained = ours.where("tag = 'sustained'").select(F.minute("breach_start"), F.minute("alert_time")).collect()
    # the episode from minute 1 would alert at 11, but its rule was deleted at 5; the next life's lasts from 30 to 40
    assert [tuple(r) for r in sustained] == [(30, 40)]


@pytest.mark.parametrize("which", ["feed", "mixed_feed"])
def test_rolling_panes(spark, request, scratch, which):
    feed = request.getfixturevalue(which)
    delay = MS if which == "feed" else "6 hours"
    ours = drain(pipelines.rolling_panes(stream(spark, feed, delay), "user_id", "ts", "cents", "2 hours", 30, "event_id", "7 hours"), f"panes_{which}", scratch)
    rows = batch(spark, feed).select("user_id", "event_id", "ts", "cents")
    expected = windows.rolling_panes(rows, ["user_id"], "ts", "cents", "2 hours", 30, ["event_id"]).withColumnRenamed("event_id", "tie")
    columns = ("user_id", "tie", "rolling_sum", "rolling_count")
    assert values(real(ours), *columns) == values(real(expected), *columns)


def test_rolling_panes_keep_a_bounded_state(spark, scratch, tmp_path):
    import json

    import pandas as pd

    from streams import write

    # one busy key: every file has 400 rows in the same four minutes' span, one file per hour
    for i in range(5):
        at = [pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i, milliseconds=600 * k) for k in range(400)]
        write(pd.DataFrame({"event_id": range(400 * i, 400 * i + 400), "ts": at, "user_id": 1, "event_type": "x", "value": 1.0, "props": "{}"}), f"{tmp_path}/part-{i}.parquet")
    rows = read_events(spark, str(tmp_path), stream=True, delay=MS, files_per_trigger=1).withColumn("cents", F.lit(1).cast("bigint"))
    out = pipelines.rolling_panes(rows, "user_id", "ts", "cents", "1 minute", 3, "event_id", "1 minute")
    query = (
        out.writeStream.format("memory").queryName("busy").outputMode("append")
        .option("checkpointLocation", f"{scratch}/busy").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    held = [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if json.loads(p.json)["stateOperators"]]
    assert spark.table("busy").count() == 1999 and max(held) <= 40 and max(held[2:]) <= held[0] + 10


def test_running_moments_of_few_keys_use_many_tasks(spark, feed, scratch):
    rows = stream(spark, feed).withColumn("stay", stay())
    ours = drain(pipelines.running_moments(rows, "region", "ts", F.col("stay"), "1 day", F.col("event_id"), salts=6), "moments", scratch)
    bounded = batch(spark, feed).withColumn("stay", stay())
    closed = bounded.withColumn("day", windows.window_start("ts", "1 day")).where(F.unix_micros("day") + 24 * HOUR_US <= until(bounded)).toPandas()
    assert len({(r, hash(k) % 6) for r, k in zip(closed["region"], closed["event_id"])}) > closed["region"].nunique()
    got = {(r["region"], r["window_start"]): r for r in ours.collect()}
    for region, part in closed.groupby("region"):
        for day in sorted(part["day"].unique()):
            so_far = part[part["day"] <= day]["stay"]
            r = got.pop((region, pd_time(day)))
            assert (r["n"], r["max"]) == (len(so_far), so_far.max())
            assert r["mean"] == pytest.approx(so_far.mean()) and r["variance"] == pytest.approx(so_far.var(ddof=0), rel=1e-9)
    assert not got


def pd_time(day):
    import pandas as pd

    return pd.Timestamp(day).to_pydatetime()


def test_alerts_do_not_depend_on_arrow_batches(spark, feed, scratch):
    """One micro-batch in reverse order, in Arrow batches of seven rows: the alert row is still the one by event time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        rows = prepared(read_events(spark, feed, stream=True, delay=MS))
        tagged = drain(pipelines.capacity_alerts(rows, "hospital", "ts", "capacity", "event_id"), "chunks", scratch)
        slots = drain(pipelines.deferred_slot(rows, "user_id", "ts", F.lit(10**13), ["event_id"]), "chunk_slots", scratch)
    finally:
        spark.conf.set(name, before)
    expected = occupancy.capacity_alerts(batch(spark, feed), "hospital", "ts", "capacity", ["event_id"])
    ours = tagged.where("tag = 'alert'").select("hospital", F.col("tie").alias("event_id"), "occupied")
    assert values(ours, "hospital", "event_id", "occupied") == values(expected, "hospital", "event_id", "occupied")
    assert tagged.where("tag = 'main'").count() == batch(spark, feed).count() and slots.count() == 0
