"""Scripted cases for the operators: thresholds, edges, unknown keys, order of arrival."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import draw, frames, news2, registry, render
from tidewatch.operators import admissions, detect, keys, occupancy, paging, rows, rules, running, timeline, windows
from tidewatch.operators.timeline import SEG, Sample, Timeline, highest, latest, lowest, planning_sample, previous, tally, total

UTC = datetime.timezone.utc


def at(ms: int) -> datetime.datetime:
    return datetime.datetime.fromtimestamp(ms / 1000, UTC).replace(tzinfo=None)


def steps(spark, *moves):
    """(hospital, +n or -n) moves as one row per bed and millisecond."""
    out, ms = [], 0
    for hospital, n in moves:
        for _ in range(abs(n)):
            ms += 1
            out.append((hospital, at(ms), 1 if n > 0 else -1, ms))
    df = spark.createDataFrame(out, "hospitalID string, ts timestamp, delta int, seq long")
    return registry.with_registry(df, registry.hospital_registry(spark))


def alerts(df, hot_rows=None):
    found = occupancy.occupancy_alerts(df, "hospitalID", "ts", "delta", "maxCapacity", ["seq"], hot_rows)
    return [
        (r["hospitalID"], r["previous_status"], r["status"], r["occupied"], r["occupancy_pct"])
        for r in found.orderBy("ts").collect()
    ]


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_all_transitions(spark, hot_rows):
    df = steps(spark, *[("HS1", n) for n in (89, 1, 9, 1, -5, -1, -9, -1)])
    assert [a[1:4] for a in alerts(df, hot_rows)] == [
        ("NORMAL", "HIGH", 90), ("HIGH", "FULL", 100), ("FULL", "HIGH", 94), ("HIGH", "NORMAL", 84),
    ]


def test_no_repeat_inside_the_band(spark):
    df = steps(spark, *[("HS1", n) for n in (90, -5, *[4, -4] * 5, 4, 1)])
    assert alerts(df) == [("HS1", "NORMAL", "HIGH", 90, 90.0)]


def test_alert_fields(spark):
    df = steps(spark, ("HS1", 89)).unionByName(
        registry.with_registry(
            spark.createDataFrame([("HS1", at(42_000), 1, 42_000)], "hospitalID string, ts timestamp, delta int, seq long"),
            registry.hospital_registry(spark),
        )
    )
    row = occupancy.occupancy_alerts(df, "hospitalID", "ts", "delta", "maxCapacity", ["seq"]).collect()[0]
    assert (row["regionID"], row["maxCapacity"], row["occupancy_pct"], row["ts"]) == ("S", 100, 90.0, at(42_000))


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_floor_at_zero(spark, hot_rows):
    df = steps(spark, ("HS1", -3), ("HS1", 90))
    assert [a[3] for a in alerts(df, hot_rows)] == [90]
    line = occupancy.occupancy(df, "hospitalID", "ts", "delta", "maxCapacity", ["seq"], hot_rows)
    assert line.frame().where("underflow").count() == 3


def test_discharge_before_its_admission(spark):
    df = steps(spark, ("HS1", -1), ("HS1", 1))
    line = occupancy.occupancy(df, "hospitalID", "ts", "delta", "maxCapacity", ["seq"]).frame()
    assert [(r["occupied"], r["underflow"]) for r in line.orderBy("ts").collect()] == [(0, True), (1, False)]


def test_unknown_hospital_has_no_state(spark):
    df = steps(spark, ("UNKNOWN", 1000), ("UNKNOWN", -2000))
    assert occupancy.occupancy(df, "hospitalID", "ts", "delta", "maxCapacity", ["seq"]).frame().count() == 0


def test_hospitals_are_apart(spark):
    df = steps(spark, ("HS1", 90), ("HS2", 89), ("HS2", 1))
    assert sorted(a[0] for a in alerts(df)) == ["HS1", "HS2"]


def test_hysteresis_walk(spark):
    ratios = [0.84, 0.90, 1.00, 0.96, 0.94, 0.84]
    df = spark.createDataFrame([("k", at(i), r) for i, r in enumerate(ratios)], "key string, ts timestamp, ratio double")
    found = occupancy.status_changes(Timeline.of(df, ["key"], "ts"), F.col("ratio"))
    assert [(r["ratio"], r["status"]) for r in found.orderBy("ts").collect()] == [
        (0.90, "HIGH"), (1.00, "FULL"), (0.94, "HIGH"), (0.84, "NORMAL"),
    ]


def test_status_can_skip_a_step(spark):
    df = spark.createDataFrame([("k", at(i), r) for i, r in enumerate([1.2, 0.1, 1.0])], "key string, ts timestamp, ratio double")
    found = occupancy.status_changes(Timeline.of(df, ["key"], "ts"), F.col("ratio")).orderBy("ts").collect()
    assert [(r["previous_status"], r["status"]) for r in found] == [("NORMAL", "FULL"), ("FULL", "NORMAL"), ("NORMAL", "FULL")]


# ---- capacity alert ----


@pytest.mark.parametrize("n, expected", [(88, []), (89, []), (90, [(90, 90.0)]), (100, [(90, 90.0)])])
def test_capacity_alert_once(spark, n, expected):
    df = steps(spark, ("HS1", n))
    found = occupancy.capacity_alerts(df, "hospitalID", "ts", "maxCapacity", ["seq"])
    assert [(r["occupied"], r["occupancy_pct"]) for r in found.collect()] == expected


@pytest.mark.parametrize("beds, first", [(100, 90), (170, 153), (200, 180), (300, 270)])
def test_capacity_alert_row(spark, beds, first):
    df = spark.range(1, beds + 1).select(F.lit("h").alias("h"), F.timestamp_micros("id").alias("ts"), F.lit(beds).alias("beds"), "id")
    assert [r["id"] for r in occupancy.capacity_alerts(df, "h", "ts", "beds", ["id"]).collect()] == [first]


def test_unknown_hospital_never_alerts(spark):
    df = steps(spark, ("UNKNOWN", 500))
    assert occupancy.capacity_alerts(df, "hospitalID", "ts", "maxCapacity", ["seq"]).count() == 0


def test_capacity_alert_is_pruned_before_the_shuffle(spark):
    df = steps(spark, ("HS1", 100))
    plan = occupancy.capacity_alerts(df, "hospitalID", "ts", "maxCapacity", ["seq"], max_capacity=300)
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_pass_through(spark):
    df = steps(spark, ("HS1", 95))
    tagged = occupancy.pass_through(df, occupancy.capacity_alerts(df, "hospitalID", "ts", "maxCapacity", ["seq"]))
    assert rows.route(tagged, "main", "tag").count() == 95
    assert rows.route(tagged, "alert", "tag").count() == 1


# ---- registry and draws ----


def test_registry(spark):
    known = {r["hospitalID"]: (r["regionID"], r["maxCapacity"]) for r in registry.hospital_registry(spark).collect()}
    assert len(known) == 14
    assert known["HNE4"] == ("NE", 200) and known["HMW3"] == ("MW", 170) and known["HW5"] == ("W", 300) and known["HS2"] == ("S", 100)
    df = spark.createDataFrame([("HS1",), ("NOPE",), (None,)], "hospitalID string")
    found = registry.with_registry(df, registry.hospital_registry(spark)).collect()
    assert [(r["regionID"], r["maxCapacity"]) for r in found] == [("S", 100), (None, -1), (None, -1)]


def test_large_reference_is_not_broadcast(spark):
    big = spark.range(50).select(F.col("id").cast("string").alias("k"))
    assert registry.small_side(big, 49) is big
    assert "ResolvedHint" in registry.small_side(big, 50)._jdf.queryExecution().analyzed().toString()


def test_length_of_stay(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("PAT-"), F.col("id") + 100_000).alias("id"))
    regions = ["NE", "MW", "W", "S", "??", None]
    means = {}
    for region in regions:
        ms = draw.length_of_stay_ms("id", F.lit(region).cast("string"))
        first = ids.agg(F.avg(ms).alias("m"), F.min(ms).alias("lo"), F.max(ms).alias("hi"), F.sum(ms).alias("s")).first()
        again = ids.agg(F.sum(ms).alias("s")).first()
        assert first["s"] == again["s"]
        lo, hi = (20, 60) if region == "S" else (5, 15)
        assert lo * 60_000 <= first["lo"] and first["hi"] <= hi * 60_000
        assert abs(first["m"] / ((lo + hi) / 2 * 60_000) - 1) < 0.05
        means[region] = first["m"]
    assert all(means["S"] > 3 * means[r] for r in regions if r != "S")


@pytest.mark.parametrize("profiles", [{"*": (0, 5)}, {"*": (5, 4)}, {"S": (1, 2)}])
def test_bad_profiles(spark, profiles):
    with pytest.raises(ValueError):
        draw.length_of_stay_ms("id", "region", profiles)


# ---- deferred emission ----


def admit(spark, *patients):
    return spark.createDataFrame([(p, "HS1", at(10_000), w) for p, w in patients], "patient string, hospital string, ts timestamp, wait long")


def test_due_exactly_at_the_watermark(spark):
    df = admit(spark, ("PAT-1", 1_000))
    assert occupancy.deferred_emit(df, "ts", F.col("wait"), 10_999_000).count() == 0
    row = occupancy.deferred_emit(df, "ts", F.col("wait"), 11_000_000).collect()[0]
    assert (row["patient"], row["hospital"], row["ts"], row["due_time"]) == ("PAT-1", "HS1", at(10_000), at(11_000))


def test_equal_deadlines_both_survive(spark):
    df = admit(spark, ("PAT-1", 1_000), ("PAT-2", 1_000))
    assert occupancy.deferred_emit(df, "ts", F.col("wait"), 11_000_000).count() == 2


def test_slot_is_overwritten(spark):
    df = spark.createDataFrame([("p", at(0), 100, 1), ("p", at(50), 500, 2)], "k string, ts timestamp, wait long, id int")
    out = occupancy.deferred_emit_single(df, ["k"], "ts", F.col("wait"), ["id"]).collect()
    assert [(r["id"], r["emitted_at"], r["due_time"]) for r in out] == [(2, at(100), at(550))]


# ---- row operators ----


def test_temperature_rules(spark):
    df = spark.createDataFrame([(str(t), float(t)) for t in (20, 28, 30, 32, 35, -999)], "s string, t double")
    valid = rows.drop_faulty(df, "t")
    counts = {r["s"]: r["n"] for r in rows.temperature_warnings(valid, "s", "t").groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert counts == {"28": 1, "30": 1, "32": 1, "35": 2}
    assert valid.count() == 5


def test_round_half_up_on_negative_ties(spark):
    got = spark.sql("select -2.5D as a, 2.5D as b, 0.25D as c").select(
        rows.round_half_up(F.col("a"), 0).alias("a"), rows.round_half_up(F.col("b"), 0).alias("b"), rows.round_half_up(F.col("c"), 1).alias("c")
    ).first()
    assert tuple(got) == (-2.0, 3.0, 0.3)


def test_split_words_keeps_inner_gaps_and_drops_trailing_ones(spark):
    df = spark.createDataFrame([("a  b ",), ("",), (" ",), ("The the.",)], "text string")
    assert [r["word"] for r in rows.split_words(df, "text").collect()] == ["a", "", "b", "", "The", "the."]


def test_malformed_lines_drop(spark):
    df = spark.createDataFrame([("101,John,25",), ("INVALID",), ("1,x,young",), ("103,Bob,42",)], "line string")
    got = rows.parse_delimited(df, "line", [("id", "int"), ("name", "string"), ("age", "int")]).collect()
    assert [tuple(r) for r in got] == [(101, "John", 25), (103, "Bob", 42)]


def test_equal_keys_share_a_partition(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("k"), "id")
    placed = keys.key_partition(df, "k", n=8).withColumn("p", F.spark_partition_id())
    assert placed.groupBy("k").agg(F.countDistinct("p").alias("n")).where("n > 1").count() == 0


def test_busy_key_is_spread(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"), "id")
    spread = keys.spread_partition(df, "k", row_id="id", n=8, hot_rows=50)
    shards = {r["k"]: r["n"] for r in spread.groupBy("k").agg(F.countDistinct("shard").alias("n")).collect()}
    assert shards[0] == 8 and set(v for k, v in shards.items() if k) == {1}
    assert spread.count() == 1000


def test_skew_report(spark):
    even = spark.range(16_000).select("id")
    assert keys.skew_report(even, "id", 4).first()["skew_pct"] < 5
    one = spark.range(100).select(F.lit(1).alias("id"))
    assert keys.skew_report(one, "id", 4).first()["skew_pct"] == pytest.approx(100.0)


# ---- timeline ----


@pytest.mark.parametrize("shape", ["even", "burst", "one_key"])
def test_scan_is_the_same_for_every_cut(spark, shape):
    rng = random.Random(7)
    data = []
    for i in range(600):
        key = 0 if shape == "one_key" else rng.choice([0, 0, 0, 1, 2])
        moment = rng.randrange(10_000) if shape != "burst" else (rng.randrange(30) if i % 3 else 10_000_000 + i)
        data.append((key, at(moment), i, rng.choice([None, rng.randrange(-5, 6)])))
    df = spark.createDataFrame(data, "k int, ts timestamp, id int, v int").cache()

    def scanned(hot_rows):
        line = Timeline.of(df, ["k"], "ts", ["id"], hot_rows).scan(
            s=total("v"), sb=total("v", before=True), n=tally(F.col("v") > 0), last=latest("v"), prev=previous("v"),
            lo=lowest("v"), hi=highest("v", before=True),
        )
        line = line.with_columns(step=F.coalesce("v", F.lit(0))).clamped_total("step", "level", "floored")
        return line, sorted((tuple(r) for r in line.frame().collect()), key=repr)

    plain, expected = scanned(None)
    assert SEG not in plain.rows.columns
    for hot_rows in (7, 50):
        cut, got = scanned(hot_rows)
        assert cut.segments > 0
        assert got == expected


def test_cuts_from_a_sample_change_nothing(spark):
    df = spark.range(2000).select((F.col("id") % 2).alias("k"), F.timestamp_millis(F.col("id") * F.col("id")).alias("ts"), "id")
    sampled = df.where("id between 300 and 1500").sample(0.2, seed=1)
    line = Timeline.of(df, ["k"], "ts", ["id"], 100, Sample(sampled, 5.0)).scan(s=total("id"))
    assert line.segments > 4
    plain = Timeline.of(df, ["k"], "ts", ["id"]).scan(s=total("id"))
    assert sorted(map(tuple, line.frame().collect())) == sorted(map(tuple, plain.frame().collect()))
    assert planning_sample(df, 500).weight == 4.0
    assert planning_sample(df).rows is df


def test_clamp_against_a_plain_walk(spark):
    rng = random.Random(3)
    walk = [rng.choice([1, -1, -1]) for _ in range(300)]
    level, expected = 0, []
    for step in walk:
        level = max(0, level + step)
        expected.append(level)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(walk)], "i long, s int")
    for hot_rows in (None, 11):
        line = Timeline.of(df, [], "i", (), hot_rows).clamped_total("s", "level", "floored")
        assert [r["level"] for r in line.frame().orderBy("i").collect()] == expected


# ---- silence, breaches ----


def test_silence_edges(spark):
    df = spark.createDataFrame([("a", at(0)), ("a", at(30_000)), ("a", at(60_001)), ("b", at(0)), ("c", at(60_000))], "k string, ts timestamp")
    got = detect.silence_resume(df, ["k"], "ts", "30 seconds", 60_001_000).orderBy("k", "alert_time").collect()
    assert [(r["k"], r["alert"], r["alert_time"]) for r in got] == [
        ("a", "SILENT", at(60_000)), ("a", "RESUMED", at(60_001)), ("b", "SILENT", at(30_000)),
    ]


def breach(spark, points, until_ms):
    df = spark.createDataFrame([("p", at(s * 1000), v) for s, v in points], "k string, ts timestamp, v int")
    got = detect.sustained_breach(df, ["k"], "ts", F.col("v") > 120, 60_000_000, until_ms * 1000)
    return [r["alert_time"] for r in got.collect()]


def test_sustained_breach(spark):
    high = [(s, 130) for s in range(0, 61, 10)]
    assert breach(spark, high, 70_000) == [at(60_000)]
    assert breach(spark, high[:-1] + [(59, 115), (61, 130)], 70_000) == []
    assert breach(spark, [(0, 130)], 59_999) == []
    assert breach(spark, [(0, 130)], 60_000) == [at(60_000)]
    assert breach(spark, [(0, 130), (100, 130), (110, 90), (120, 130)], 185_000) == [at(60_000), at(180_000)]


# ---- vitals ----


def test_frames(spark):
    lines = [
        "VW1|MON-0712|P-1007|ICU-A|1727500000000|HR=88;SPO2=97;RR=16;SBP=120;DBP=80;TEMP=98.6F;O2=N;CONSC=A",
        "VW1|MON-0712|P-1007|ICU-A|1727500000000|HR=abc;SPO2=97;RR=16;SBP=120;DBP=80;TEMP=36.5C;O2=Y;CONSC=U",
        "VW2|MON-0712|P-1007|ICU-A|1727500000000|HR=88",
        "VW1|MON-0712|P-1007",
        "VW1|MON-0712|P-1007|ICU-A|later|HR=88",
        "VW1|MON-0712||ICU-A|1727500000000|HR=88",
        "VW1|MON-0712|P-1|ICU-A|1727500000000|HR=88;HR=90;junk;=4",
    ]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    parsed = frames.parse_frames(df, "line")
    errors = {r["i"]: r["parseError"] for r in parsed.collect()}
    assert [i for i, e in errors.items() if e is None] == [0, 1, 6]
    assert errors[2] == "unknown version VW2" and errors[3] == "expected 6 fields, got 3"
    assert errors[4] == "bad timestamp" and errors[5] == "empty identifier"
    readings = frames.explode_frames(parsed.where("i < 2"))
    by_code = {(r["vitalCode"], round(r["value"], 1)) for r in readings.collect()}
    assert readings.count() == 15
    assert ("TEMP", 37.0) in by_code and ("O2", 1.0) in by_code and ("CONSC", 4.0) in by_code
    assert [r["value"] for r in frames.explode_frames(parsed.where("i = 6")).collect()] == [90.0]


def test_quality_routes(spark):
    data = [("HR", 0.0, 0), ("HR", 10.0, 0), ("HR", 80.0, 0), ("SPO2", 0.0, 0), ("SPO2", 104.0, 0), ("TEMP", 0.0, 0), ("HR", 80.0, 600_000), ("HR", 80.0, 300_000)]
    df = spark.createDataFrame([(c, v, at(s)) for c, v, s in data], "vitalCode string, value double, timestamp timestamp")
    routed = frames.quality_gate(df, F.timestamp_millis(F.lit(0))).collect()
    assert [r["route"] for r in routed] == ["artifact", "impossible", "clean", "artifact", "impossible", "impossible", "clock-skew", "clean"]
    assert [r["skewMillis"] for r in routed][6:] == [600_000, None]


BOUNDS = {
    "RR": [(8, 3), (9, 1), (11, 1), (12, 0), (20, 0), (21, 2), (24, 2), (25, 3)],
    "SPO2": [(91, 3), (92, 2), (93, 2), (94, 1), (95, 1), (96, 0)],
    "O2": [(0, 0), (1, 2)],
    "SBP": [(90, 3), (91, 2), (100, 2), (101, 1), (110, 1), (111, 0), (219, 0), (220, 3)],
    "HR": [(40, 3), (41, 1), (50, 1), (51, 0), (90, 0), (91, 1), (110, 1), (111, 2), (130, 2), (131, 3)],
    "CONSC": [(0, 0), (1, 3), (4, 3)],
    "TEMP": [(35.0, 3), (35.1, 1), (36.0, 1), (36.1, 0), (38.0, 0), (38.1, 1), (39.0, 1), (39.1, 2)],
}


def test_news2_points_at_every_bound(spark):
    data = [(code, float(v), p) for code, pairs in BOUNDS.items() for v, p in pairs]
    df = spark.createDataFrame(data, "code string, v double, expected int")
    assert df.where(news2.points_by_code(F.col("code"), F.col("v")) != F.col("expected")).count() == 0


def test_news2_bands(spark):
    data = [(0, False, "LOW"), (4, False, "LOW"), (3, True, "LOW-MEDIUM"), (5, True, "MEDIUM"), (6, False, "MEDIUM"), (7, False, "HIGH")]
    df = spark.createDataFrame(data, "t int, three boolean, expected string")
    assert df.where(news2.band(F.col("t"), F.col("three")) != F.col("expected")).count() == 0


# ---- rules ----


def commands(spark, *lines):
    df = spark.createDataFrame([(at(ms), line) for ms, line in lines], "ts timestamp, line string")
    return frames.parse_rules(df, "line")


def test_rule_lines(spark):
    parsed = commands(
        spark, (1, "RULE|UPSERT|R|*|HR|0|120|60|HIGH"), (2, "RULE|DELETE|R"), (3, "RULE|UPSERT|R|*|HR|low|120|60|HIGH"),
        (4, "CAREPLAN|UPSERT|P-1002|SPO2|88|100"), (5, "CAREPLAN|DELETE|P-1002|SPO2"), (6, "RULE|UPSERT|R|*|HR"), (7, "NOISE"),
    )
    assert [r["ts"] for r in parsed.orderBy("ts").collect()] == [at(1), at(2), at(4), at(5)]


def hr(spark, *points):
    return spark.createDataFrame(
        [(p, w, "HR", float(v), at(ms), ms) for p, w, v, ms in points], "patientId string, wardId string, vitalCode string, value double, ts timestamp, id long"
    )


def test_rules_change_while_running(spark):
    feed = commands(
        spark, (100, "RULE|UPSERT|R-HR|*|HR|0|120|60|HIGH"), (200, "RULE|UPSERT|R-HR|*|HR|0|110|60|HIGH"),
        (300, "RULE|UPSERT|R-B|ICU-B|HR|0|200|60|HIGH"), (400, "RULE|DELETE|R-HR"),
    )
    defaults = spark.createDataFrame([("D", "*", "HR", 0.0, 100.0, 60, "LOW")], "ruleId string, wardId string, vitalCode string, min double, max double, sustainSeconds int, severity string")
    held = rules.rule_set(rules.versions(feed, ["ruleId"], "ts", rules.RULE_FIELDS), defaults)
    readings = hr(spark, *[(f"P{i}", ward, 115, ms) for i, (ward, ms) in enumerate([
        ("ICU-A", 50), ("ICU-A", 150), ("ICU-A", 200), ("ICU-B", 250), ("ICU-B", 350), ("ICU-A", 351), ("ICU-A", 400),
    ])])
    got = sorted((r["patientId"], r["ruleId"]) for r in rules.threshold_alerts(readings, held, "ts").collect())
    assert got == [("P0", "D"), ("P2", "R-HR"), ("P3", "R-HR"), ("P5", "R-HR")]
    for bucket in ("1 millisecond", "1 hour", "3650 days"):
        again = rules.threshold_alerts(readings, held, "ts", bucket)
        assert sorted((r["patientId"], r["ruleId"]) for r in again.collect()) == got


@pytest.mark.parametrize("bucket", ["1 millisecond", "10 seconds", "3650 days"])
def test_equal_readings_and_odd_rows_are_matched_once_each(spark, bucket, monkeypatch):
    feed = commands(spark, (100, "RULE|UPSERT|R-A|ICU-A|HR|0|110|60|HIGH"), (200, "RULE|UPSERT|R-ALL|*|HR|0|110|60|HIGH"))
    held = rules.versions(feed, ["ruleId"], "ts", rules.RULE_FIELDS)
    rows = hr(spark, ("P", "ICU-A", 115, 50), ("P", "ICU-A", 115, 250), ("P", "ICU-A", 115, 250), ("P", "ICU-B", 115, 250), ("P", None, 115, 30_000))
    rows = rows.unionByName(rows.limit(1).withColumn("ts", F.lit(None).cast("timestamp")))
    expected = sorted([("ICU-A", "R-A"), ("ICU-A", "R-A"), ("ICU-B", "R-ALL"), (None, "R-ALL")], key=str)
    for copies in (rules.BROADCAST_COPIES, 0):
        monkeypatch.setattr(rules, "BROADCAST_COPIES", copies)
        got = [(r["wardId"], r["ruleId"]) for r in rules.match_rules(rows, held, "ts", bucket).collect()]
        assert sorted(got, key=str) == expected
    assert rules.match_rules(rows, held.limit(0), "ts", bucket).isEmpty()
    assert rules.match_rules(rows.limit(0), held, "ts", bucket).isEmpty()


def test_many_rule_versions_need_no_row_id(spark):
    feed = spark.range(20_000).select(
        F.timestamp_millis(F.col("id") * 1000).alias("ts"), "id", F.lit("R").alias("ruleId"), F.lit("*").alias("wardId"), F.lit("HR").alias("vitalCode"),
        F.lit(0.0).alias("min"), F.col("id").cast("double").alias("max"), F.lit(60).alias("sustainSeconds"), F.lit("LOW").alias("severity"), F.lit("UPSERT").alias("op"),
    )
    held = rules.versions(feed, ["ruleId"], "ts", rules.RULE_FIELDS, ["id"])
    found = rules.match_rules(hr(spark, ("P", "ICU-A", 115, 7_500), ("P", "ICU-A", 115, 19_999_999)), held, "ts", "1 hour")
    assert sorted(r["rule_max"] for r in found.collect()) == [7.0, 19_999.0]


@pytest.mark.parametrize("hot_rows", [None, 40])
def test_matching_in_order_equals_matching_by_buckets(spark, hot_rows):
    """All in one hour and over ten years, wards with and without rules of their own, rules that move, ties, nulls."""
    rng = random.Random(8)

    def moment(dense):
        return rng.randrange(3_600_000) if dense else rng.randrange(10 * 365 * 86_400_000)

    for dense in (True, False):
        feed = []
        for k in range(250):
            rule, ward, vital = f"R{rng.randrange(9)}", rng.choice(["*", "A", "B"]), rng.choice(["HR", "SPO2"])
            feed.append((moment(dense), f"RULE|UPSERT|{rule}|{ward}|{vital}|{rng.randrange(50)}|{rng.randrange(50, 100)}|60|LOW" if rng.random() < 0.7 else f"RULE|DELETE|{rule}"))
        feed += [(feed[0][0], "RULE|UPSERT|R0|*|HR|1|2|60|LOW"), (feed[0][0], "RULE|UPSERT|R0|A|HR|3|4|60|LOW")]
        parsed = commands(spark, *feed).withColumn("tie", F.monotonically_increasing_id())
        defaults = spark.createDataFrame([("D", "*", "HR", 0.0, 9.0, 60, "LOW"), ("E", "A", "HR", 0.0, 8.0, 60, "LOW")], "ruleId string, wardId string, vitalCode string, min double, max double, sustainSeconds int, severity string")
        held = rules.rule_set(rules.versions(parsed, ["ruleId"], "ts", rules.RULE_FIELDS, ["tie"]), defaults).cache()
        times = [t for t, _ in feed]
        points = [(f"P{k}", rng.choice(["A", "B", "C", None, "*"]), rng.randrange(100), rng.choice(times) if rng.random() < 0.3 else moment(dense)) for k in range(400)]
        readings = hr(spark, *points).withColumn("vitalCode", F.when(F.col("value") < 70, "HR").otherwise("SPO2"))
        readings = readings.union(readings.limit(5)).union(readings.limit(5).withColumn("ts", F.lit(None).cast("timestamp"))).cache()
        got = rules.match_in_order(readings, held, "ts", hot_rows)
        want = rules.match_rules(readings, held, "ts", "1 minute" if dense else "100 days")
        assert got.columns == want.columns
        rows_of = [sorted((tuple(r) for r in df.collect()), key=repr) for df in (got, want)]
        assert rows_of[0] == rows_of[1] and len(rows_of[0]) > 300
    assert rules.match_in_order(readings.limit(0), held, "ts").isEmpty() and rules.match_in_order(readings, held.limit(0), "ts").isEmpty()


def test_deleted_rule_does_not_fire(spark):
    feed = commands(spark, (0, "RULE|UPSERT|R-HR|*|HR|0|120|60|HIGH"), (30_000, "RULE|DELETE|R-HR"), (40_000, "RULE|UPSERT|R-HR|*|HR|0|120|60|HIGH"))
    held = rules.versions(feed, ["ruleId"], "ts", rules.RULE_FIELDS)
    matched = rules.match_rules(hr(spark, *[("P", "ICU-A", 130, ms) for ms in range(1_000, 121_000, 5_000)]), held, "ts")
    got = rules.sustained_rule_breach(matched, "ts", 200_000_000, ["id"]).collect()
    assert [(r["breach_start"], r["alert_time"]) for r in got] == [(at(41_000), at(101_000))]


def test_care_plan_suppresses(spark):
    feed = commands(spark, (0, "RULE|UPSERT|R|*|HR|0|120|60|HIGH"), (100, "CAREPLAN|UPSERT|P-1002|HR|0|140"))
    held = rules.versions(feed.where("kind = 'RULE'"), ["ruleId"], "ts", rules.RULE_FIELDS)
    plans = rules.versions(feed.where("kind = 'CAREPLAN'"), ["patientId", "vitalCode"], "ts", ["min", "max"])
    matched = rules.match_rules(hr(spark, ("P-1002", "ICU-A", 130, 50), ("P-1002", "ICU-A", 130, 150), ("P-1", "ICU-A", 130, 150), ("P-1002", "ICU-A", 150, 160)), held, "ts")
    got = sorted((r["patientId"], r["id"], r["route"], r["by_plan"]) for r in rules.with_care_plan(matched, plans, "ts").collect())
    assert got == [("P-1", 150, "alert", False), ("P-1002", 50, "alert", False), ("P-1002", 150, "suppressed", True), ("P-1002", 160, "alert", True)]


# ---- paging ----


def walk(times, within):
    kept, last = [], None
    for t in times:
        if last is None or t - last >= within:
            kept.append(t)
            last = t
    return kept


@pytest.mark.parametrize("gap", [1, 40, 300])
@pytest.mark.parametrize("hot_rows", [None, 9, 64])
def test_suppression_against_a_plain_walk(spark, gap, hot_rows):
    rng = random.Random(gap)
    data, expected = [], []
    for key in range(3):
        t, times = 0, []
        for _ in range(200 if key else 400):
            t += rng.randrange(gap + 1)
            times.append(t)
        data += [(key, at(t * 1000), i) for i, t in enumerate(times)]
        expected += [(key, at(t * 1000)) for t in walk(times, 120)]
    df = spark.createDataFrame(data, "k int, ts timestamp, id int")
    kept = paging.suppress_repeats(df, ["k"], "ts", "2 minutes", ["id"], hot_rows)
    assert sorted((r["k"], r["ts"]) for r in kept.collect()) == expected


def test_pages_of_ten_and_urgent_flush(spark):
    data = [(0, at(i), i == 14, i) for i in range(23)]
    df = spark.createDataFrame(data, "shard int, ts timestamp, urgent boolean, id int")
    for hot_rows in (None, 4):
        got = paging.page_batches(df, ["shard"], "ts", F.col("urgent"), ["id"], hot_rows=hot_rows).orderBy("flushed_at").collect()
        assert [(r["alerts"], r["flushed_at"]) for r in got] == [(10, at(9)), (5, at(14))]


# ---- windows and text ----


def test_window_without_seniors_counts_zero(spark):
    df = spark.createDataFrame([("NE", 65, at(0)), ("NE", 66, at(130_000)), ("W", 30, at(1))], "regionID string, age int, ts timestamp")
    got = {(r["regionID"], r["window_start"]): r["n"] for r in admissions.measure_by_region(df, "ts").collect()}
    assert got == {("NE", at(0)): 0, ("NE", at(120_000)): 1, ("W", at(0)): 0}


def test_network_counts_unknown_region_in_the_total_only(spark):
    df = spark.createDataFrame([("NE", 70, at(0)), (None, 70, at(1)), ("S", 20, at(2))], "regionID string, age int, ts timestamp")
    row = admissions.measure_all_regions(df, "ts").first()
    assert [row[c] for c in ("total", "NE", "MW", "W", "S")] == [2, 1, 0, 0, 0]


def test_session_gap_edges(spark):
    df = spark.createDataFrame([("b", at(t)) for t in (0, 10_000, 20_001)], "k string, ts timestamp")
    got = windows.sessions(df, "ts", "10 seconds", ["k"], {"n": F.count("ts")}).orderBy("session_start").collect()
    assert [(r["session_start"], r["session_end"], r["n"]) for r in got] == [(at(0), at(20_000), 2), (at(20_001), at(30_001), 1)]


def test_rendered_lines(spark):
    df = spark.createDataFrame(
        [(at(3_600_000), at(3_720_000), "S", 7, "HS1", 90, 100, 90.0)],
        "a timestamp, b timestamp, r string, n long, h string, o int, c int, p double",
    )
    got = df.select(
        render.regional_line("a", "b", "r", "n"), render.capacity_line("a", "h", "r", "o", "c", "p"),
        render.occupancy_line("a", "r", "h", "h", "r", "o", "c", "p"),
    ).first()
    assert list(got) == [
        "[01:00:00 - 01:02:00] Region S  ->   7 admissions",
        "[01:00:00] ALERT: Hospital HS1 (Region S) at 90/100 beds (90.0% capacity)",
        "[01:00:00] S -> HS1: Hospital HS1 (Region S) at 90/100 beds (90.0% occupancy)",
    ]


@pytest.mark.parametrize("hot_rows", [None, 50])
@pytest.mark.parametrize("level, step", [(36.6, 0.0), (1e8, 1.0)])
def test_steady_readings_have_no_outliers(spark, hot_rows, level, step):
    rows = spark.range(600).selectExpr("id", "1 AS k", f"double({level}) + {step} * (id % 3) AS x", "timestamp_seconds(id) AS ts")
    assert running.baseline_outliers(rows, ["k"], "ts", "x", ["id"], hot_rows=hot_rows).where("is_outlier").count() == 0


def test_early_counts_end_with_a_final_row(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (200, "a"), (3700, "b")], "s long, k string").selectExpr("timestamp_seconds(s) AS ts", "k")
    got = windows.early_counts(rows, "ts", "1 hour", "15 minutes", ["k"], F.lit(1)).collect()
    assert [r["partial_count"] for r in sorted(got, key=lambda r: (r["k"], r["fire_time"]))] == [3, 3, 3, 3, 1, 1, 1, 1]
    assert sum(r["is_final"] for r in got) == 2


# ---- cutting long keys ----


@pytest.mark.parametrize("collected", [50_000, 1])
@pytest.mark.parametrize("keyed", [True, False])
def test_every_long_key_and_every_burst_is_cut(spark, monkeypatch, collected, keyed):
    monkeypatch.setattr(timeline, "MAX_COLLECTED_CUTS", collected if keyed else 50_000)
    # a third of each key's rows lie within 200 microseconds of thirty days
    points = [(k, i * 12_960_000_000 if i % 3 else 1_000_000 + i, i) for k in range(4) for i in range(200)]
    df = spark.createDataFrame(points, "k int, us long, i long").withColumn("ts", F.timestamp_micros("us"))
    line = Timeline.of(df, ["k"] if keyed else [], "ts", ["i", "k"], 20)
    longest = line.rows.groupBy(*line.keys, SEG).count().agg(F.max("count")).first()[0]
    assert longest <= 20
    got = {(r["k"], r["i"]): r["n"] for r in line.scan(n=total(F.lit(1).cast("long"))).frame().collect()}
    groups = [[p for p in points if p[0] == k] for k in range(4)] if keyed else [points]
    expected = {(p[0], p[2]): n for g in groups for n, p in enumerate(sorted(g, key=lambda p: (p[1], p[2], p[0])), 1)}
    assert got == expected


def test_highest_before_scans_ranges_without_one_task(spark):

    rng = random.Random(4)
    rows = [(k // 3 if k % 5 else k, rng.randrange(1000) if rng.random() < 0.9 else None) for k in range(400)] + [(None, 5)]
    table = spark.createDataFrame([(k, o, v) for k, (o, v) in enumerate(rows)], "id long, o long, v long").repartition(4)
    distinct = table.groupBy("o").agg(F.min("id").alias("id"), F.min("v").alias("v")).where("o is not null")
    for ranges in (1, 2, 7, 64):
        got = windows.highest_before(distinct, "o", F.col("v"), "top", ranges)
        held, top = {r["o"]: r for r in got.collect()}, None
        for o in sorted(held):
            assert held[o]["top"] == top
            top = held[o]["v"] if top is None else max(top, held[o]["v"] or 0)
        assert set(got.columns) == {"id", "o", "v", "top"}
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ranges == 1 or "SinglePartition" not in plan
    assert windows.highest_before(table, "o", F.col("v"), "top").count() == 401
    assert windows.highest_before(table.limit(0), "o", F.col("v"), "top").collect() == []
