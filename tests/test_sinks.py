"""Restart on a checkpoint, fan-out, rate limits, live rules, processing-time silence, counters."""

from __future__ import annotations

import time
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from streams import HEARTBEAT_USER, event_files, values, write
from tidewatch.functions import frames
from tidewatch.operators import occupancy, rules, windows
from tidewatch.sources.sinks import checkpoint_folder, fan_out, overwrite_batch, write_labelled
from tidewatch.sources.tables import read_events, stamp_ingest
from tidewatch.streaming import metrics, pipelines


def rows_at(folder: str, name: str, rows: list[tuple]) -> None:
    """Rows of (event_id, seconds, user)."""
    frame = pd.DataFrame(rows, columns=["event_id", "s", "user_id"])
    frame["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(frame["s"], unit="s")
    write(frame.drop(columns="s").assign(event_type="x", value=1.0, props="{}"), f"{folder}/{name}.parquet")


def test_pending_records_survive_a_restart(spark, tmp_path, scratch):
    feed = tmp_path / "feed"
    feed.mkdir()

    def run():
        rows = read_events(spark, str(feed), stream=True, delay="1 millisecond", files_per_trigger=1)
        held = pipelines.deferred_emit(rows, "user_id", "ts", F.lit(60_000), ["event_id"])
        write_labelled(held, "restart", f"{scratch}/state", "parquet", path=f"{scratch}/rows").awaitTermination()
        return [r["event_id"] for r in spark.read.schema(held.schema).parquet(f"{scratch}/rows").orderBy("event_id").collect()]

    rows_at(str(feed), "a", [(1, 0, 7), (2, 10, 7), (3, 10, 8)])
    assert run() == []
    rows_at(str(feed), "b", [(4, 61, 9)])
    assert run() == [1]
    assert run() == [1]
    rows_at(str(feed), "c", [(5, 600, 9)])
    assert run() == [1, 2, 3, 4]


def test_equal_deadlines_on_one_key_both_come_out(spark, tmp_path, scratch):
    rows_at(str(tmp_path), "a", [(1, 0, 7), (2, 0, 7), (3, 0, 8)])
    rows_at(str(tmp_path), "b", [(9, 100, 1)])
    rows = read_events(spark, str(tmp_path), stream=True, delay="1 millisecond", files_per_trigger=1)
    held = pipelines.deferred_emit(rows, "user_id", "ts", F.lit(60_000), ["event_id"])
    write_labelled(held, "collide", f"{scratch}/state", "parquet", path=f"{scratch}/rows").awaitTermination()
    got = spark.read.parquet(f"{scratch}/rows")
    assert values(got, "event_id") == [(1,), (2,), (3,)]


def test_slot_overwrite_emits_the_later_record_on_the_first_timer(spark, tmp_path, scratch):
    for i, (event, s) in enumerate([(1, 0), (2, 30), (3, 70), (4, 500)]):
        rows_at(str(tmp_path), f"{i}", [(event, s, 7 if event < 4 else 8)])
    rows = read_events(spark, str(tmp_path), stream=True, delay="1 millisecond", files_per_trigger=1)
    out = pipelines.deferred_slot(rows, "user_id", "ts", F.lit(60_000), ["event_id"])
    write_labelled(out, "slot", f"{scratch}/state", "parquet", path=f"{scratch}/rows").awaitTermination()
    got = spark.read.parquet(f"{scratch}/rows").where("user_id = 7")
    batch = read_events(spark, str(tmp_path)).where("user_id = 7").select("user_id", "event_id", "ts")
    expected = occupancy.deferred_emit_single(batch, ["user_id"], "ts", F.lit(60_000), ["event_id"])
    assert values(expected, "event_id") == [(2,), (3,)]
    # row 3 comes in the micro-batch that moves the watermark past the first timer, so it is what the slot holds
    assert [v for (v,) in values(got, "event_id")] in ([2, 3], [3])


def test_every_consumer_sees_every_row(spark, scratch, tmp_path):
    feed = event_files(SMALL, str(tmp_path), files=3)
    rows = read_events(spark, feed, stream=True, delay="1 millisecond", files_per_trigger=1)
    seen = {"n": 0}

    def count(batch, batch_id):
        seen["n"] += batch.count()

    query = fan_out(rows, "fan", f"{scratch}/state", {"count": count, "files": overwrite_batch(f"{scratch}/copy")})
    query.awaitTermination()
    total = read_events(spark, feed).count()
    assert seen["n"] == total
    assert spark.read.parquet(f"{scratch}/copy").count() == total
    # a batch delivered again replaces its own folder
    again = read_events(spark, feed).limit(5)
    overwrite_batch(f"{scratch}/copy")(again, 0)
    overwrite_batch(f"{scratch}/copy")(again, 0)
    assert spark.read.parquet(f"{scratch}/copy").where("batch = 0").count() == 5


def test_files_per_trigger_limits_a_batch(spark, scratch):
    feed = event_files(SMALL, scratch, files=4)
    rows = stamp_ingest(read_events(spark, feed, stream=True, files_per_trigger=2))
    query = write_labelled(rows, "limited", f"{scratch}/state", "memory")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert query.name == "limited"
    assert spark.table("limited").where("ingest_time is null").count() == 0


def test_window_state_is_dropped_behind_the_watermark(spark, scratch):
    feed = event_files(SMALL, scratch, files=3)
    rows = read_events(spark, feed, stream=True, delay="1 millisecond", files_per_trigger=1)
    counted = windows.tumbling(
        metrics.observed(rows, "seen", readings_processed=F.count(F.lit(1))), "ts", "1 hour", ["user_id"], {"n": F.count("ts")}
    )
    counters = metrics.Counters.attached(spark)
    query = write_labelled(counted, "cleaned", f"{scratch}/state", "memory")
    query.awaitTermination()
    counters.wait(query)
    spark.streams.removeListener(counters)
    assert metrics.state_rows(query) <= 1
    assert counters.totals(query, "seen") == {"readings_processed": read_events(spark, feed).count()}
    assert counters.rows_dropped_late(query) == 0


def test_counters_outlive_the_batches_a_query_remembers(spark, scratch):
    feed = event_files(SMALL, scratch, files=8)
    rows = read_events(spark, feed, stream=True, files_per_trigger=1)
    counters = metrics.Counters.attached(spark)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        query = write_labelled(metrics.observed(rows, "seen", n=F.count(F.lit(1)), users=F.count("user_id")), "counted", f"{scratch}/state", "memory")
        query.awaitTermination()
        counters.wait(query)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(counters)
    total = read_events(spark, feed).count()
    assert len(query.recentProgress) <= 2 and sum(p["numInputRows"] for p in query.recentProgress) < total
    assert counters.totals(query, "seen") == {"n": total, "users": total}
    assert counters.totals(query, "unseen") == {}


def test_rules_can_change_between_batches(spark, scratch, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    rule_file = f"{tmp_path}/rules.txt"
    seen: dict[int, int] = {}

    def read_rules(session):
        lines = session.read.text(rule_file).select(F.col("value").alias("line"), F.timestamp_millis(F.lit(0)).alias("ts"))
        return rules.versions(frames.parse_rules(lines, "line"), ["ruleId"], "ts", rules.RULE_FIELDS)

    def deliver(alerts, batch_id):
        seen[batch_id] = alerts.count()

    def run():
        rows = read_events(spark, str(feed), stream=True, files_per_trigger=1).select(
            F.lit("P").alias("patientId"), F.lit("ICU-A").alias("wardId"), F.lit("HR").alias("vitalCode"), F.lit(115.0).alias("value"), "ts", "event_id"
        )
        consume = pipelines.with_live_rules(read_rules, "ts", deliver)
        fan_out(rows, "live", f"{scratch}/state", {"alerts": consume}).awaitTermination()

    with open(rule_file, "w") as out:
        out.write("RULE|UPSERT|R-HR|*|HR|0|120|60|HIGH\n")
    rows_at(str(feed), "a", [(1, 0, 7)])
    run()
    with open(rule_file, "w") as out:
        out.write("RULE|UPSERT|R-HR|*|HR|0|110|60|HIGH\n")
    rows_at(str(feed), "b", [(2, 1, 7)])
    run()
    assert seen == {0: 0, 1: 1}


def test_silence_by_processing_time(spark, scratch, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    rows_at(str(feed), "a", [(1, 0, 7)])
    rows = read_events(spark, str(feed), stream=True)
    query = write_labelled(
        pipelines.idle_keys(rows, "user_id", "2 seconds"), "idle", f"{scratch}/state", "memory", mode="update", interval="1 second"
    )

    def wait_for(alert, n):
        for _ in range(80):
            if spark.table("idle").where(F.col("alert") == alert).count() >= n:
                return
            time.sleep(0.5)
        raise AssertionError(f"no {alert}")

    try:
        wait_for("SILENT", 1)
        rows_at(str(feed), "b", [(2, 5, 7)])
        wait_for("RESUMED", 1)
        wait_for("SILENT", 2)
    finally:
        query.stop()
    assert [a for (a,) in spark.table("idle").orderBy("ms").select("alert").collect()][:3] == ["SILENT", "RESUMED", "SILENT"]


class Session:
    """Only what the folder choice looks at."""

    def __init__(self, master: str, **conf: str):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda key, default=None: conf.get(key, default))


def test_checkpoint_folder_follows_the_cluster_setting():
    shared = {"spark.checkpoint.dir": "hdfs:///shared/"}
    assert checkpoint_folder(Session("yarn", **shared), "q") == "hdfs:///shared/q"
    assert checkpoint_folder(Session("local[2]"), "q").endswith("/q") and checkpoint_folder(Session("local"), "q").endswith("/q")
    for master in ("yarn", "local-cluster[2,1,1024]"):  # executors of their own see no folder of the driver
        with pytest.raises(ValueError):
            checkpoint_folder(Session(master), "q")


def test_sustained_rule_breach_stream(spark, scratch, tmp_path):
    feed = event_files(SMALL, str(tmp_path))
    script = [("2024-01-01", "RULE|UPSERT|R1|*|click|0|20|1800|HIGH"), ("2024-01-02", "RULE|UPSERT|R2|*|view|0|20|1800|HIGH"), ("2024-01-20", "RULE|DELETE|R1")]
    lines = spark.createDataFrame(script, "at string, line string").withColumn("ts", F.col("at").cast("timestamp")).drop("at")
    held = rules.versions(frames.parse_rules(lines, "line"), ["ruleId"], "ts", rules.RULE_FIELDS)

    def matched(rows):
        readings = rows.select("event_id", "ts", F.col("user_id").alias("patientId"), F.lit("ICU-A").alias("wardId"), F.col("event_type").alias("vitalCode"), "value")
        found = rules.match_rules(readings, held, "ts")
        return found.withColumns({"min": F.col("rule_min"), "max": F.col("rule_max")})

    stream = read_events(spark, feed, stream=True, delay="1 millisecond", files_per_trigger=1)
    out = pipelines.sustained_rule_breach(matched(stream), "patientId", "ts", "event_id", us_per_second=100_000_000, slot="1 day")
    write_labelled(out, "rule_breach", f"{scratch}/state", "parquet", path=f"{scratch}/rows").awaitTermination()
    rows = read_events(spark, feed)
    expected = rules.sustained_rule_breach(matched(rows), "ts", occupancy.closed_until(rows, "ts"), ["event_id"], us_per_second=100_000_000)
    columns = ("patientId", "ruleId", "breach_start", "alert_time")
    real = F.col("patientId") != HEARTBEAT_USER
    got = values(spark.read.parquet(f"{scratch}/rows").where(real), *columns)
    assert got == values(expected.where(real), *columns)
    assert got


def test_kept_counters_survive_a_stop_a_replay_and_a_restart(spark, scratch, tmp_path):
    """The sink fails after a batch's rows are out; the batch comes again and counts once."""
    feed = tmp_path / "feed"
    feed.mkdir()
    kept, state, delivered = f"{scratch}/kept", f"{scratch}/state", []

    def run(fail_at=None):
        def consume(batch, batch_id):
            delivered.append((batch_id, batch.count()))
            if batch_id == fail_at:
                raise RuntimeError("sink is gone")

        rows = read_events(spark, str(feed), stream=True, files_per_trigger=1)
        counted = metrics.keeping(kept, consume, readings=F.count(F.lit(1)), views=F.count_if(F.col("user_id") == 7))
        writer = rows.writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(counted)
        writer.start().awaitTermination()

    rows_at(str(feed), "a", [(1, 0, 7), (2, 1, 8)])
    run()
    assert metrics.kept_totals(spark, kept, "readings", "views") == {"readings": 2, "views": 1}
    rows_at(str(feed), "b", [(3, 2, 7), (4, 3, 7), (5, 4, 9)])
    with pytest.raises(Exception, match="sink is gone"):
        run(fail_at=1)
    assert metrics.kept_totals(spark, kept, "readings", "views") == {"readings": 2, "views": 1}
    rows_at(str(feed), "c", [(6, 5, 9)])
    run()  # batch 1 again, then batch 2
    assert delivered == [(0, 2), (1, 3), (1, 3), (2, 1)]
    assert metrics.kept_totals(spark, kept, "readings", "views") == {"readings": 6, "views": 3}
    # a batch that is written again, as after a failure between its counters and the commit, replaces its row
    again = read_events(spark, str(feed)).where("event_id in (3, 4, 5)")
    metrics.keeping(kept, lambda batch, batch_id: None, readings=F.count(F.lit(1)), views=F.count_if(F.col("user_id") == 7))(again, 1)
    assert metrics.kept_totals(spark, kept, "readings", "views") == {"readings": 6, "views": 3}
    assert metrics.kept_totals(spark, kept, "readings", upto=0) == {"readings": 2}
