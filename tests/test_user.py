"""Doors for user code: set-up per partition, batched lookups, user aggregates on busy keys."""

from __future__ import annotations

import os
import time
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import user
from tidewatch.functions.lookup import lookup_async


def test_a_resource_is_opened_and_closed_once_per_partition(spark, scratch):
    def note(kind: str) -> None:
        open(f"{scratch}/{kind}-{uuid.uuid4().hex}", "w").close()

    def connect() -> dict:
        note("open")
        return {k: f"ward {k}" for k in range(10)}

    def look_up(rows: pd.DataFrame, names: dict) -> pd.DataFrame:
        return rows.assign(ward=rows["id"].mod(20).map(names)).dropna()

    rows = spark.range(1_000, numPartitions=3)
    got = user.map_batches(rows, look_up, "id bigint, ward string", open=connect, close=lambda _: note("close"))
    assert {(r["id"], r["ward"]) for r in got.collect()} == {(k, f"ward {k % 20}") for k in range(1_000) if k % 20 < 10}
    made = [name.split("-")[0] for name in os.listdir(scratch)]
    assert made.count("open") == made.count("close") == 3


def test_a_resource_is_closed_when_the_user_code_fails(spark, scratch):
    def fail(rows: pd.DataFrame, _) -> pd.DataFrame:
        raise ValueError("no such ward")

    got = user.map_batches(spark.range(5, numPartitions=1), fail, "id bigint", open=dict, close=lambda _: open(f"{scratch}/closed", "w").close())
    with pytest.raises(Exception, match="no such ward"):
        got.collect()
    assert os.listdir(scratch) == ["closed"]


@pytest.mark.parametrize("held", [0, 10_000])
def test_a_user_aggregate_merges_every_part_of_a_busy_key(spark, held):
    rows = spark.range(9_000, numPartitions=70).selectExpr("CASE WHEN id % 3 = 0 THEN 'rare' || id % 9 WHEN id % 11 > 0 THEN 'busy' END AS k", "id")
    got = user.aggregate_with(
        rows,
        "k",
        {"s": "bigint", "most": "bigint"},
        lambda part: {"s": int(part["id"].sum()), "most": int(part["id"].max())},
        lambda a, b: {"s": a["s"] + b["s"], "most": max(a["most"], b["most"])},
        lambda a: a,
        {"s": "bigint", "most": "bigint"},
        held_keys=held,
    )
    want = rows.groupBy("k").agg({"id": "sum"}).collect()
    assert {(r["k"], r["s"]) for r in got.collect()} == {tuple(r) for r in want}
    assert got.where("false").count() == 0 and user.aggregate_with(rows.where("false"), "k", {"s": "bigint"}, dict, dict, dict, {"s": "bigint"}).count() == 0


def test_full_windows_stream_through_the_user_code(spark):
    """Windows of 1,000 and more rows reach the function in pieces of at most 50, in order, cut at the window's border."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rows = spark.range(5_000).selectExpr("timestamp_seconds(id * 3) AS ts", "nullif(id % 3, 0) AS k", "(id * 7919) % 5000 AS v", "id")

        def walk(window, pieces):
            n, last, jumps, longest = 0, None, 0, 0
            for part in pieces:
                assert part["ts"].between(window["window_start"], window["window_end"], inclusive="left").all()
                assert (part["k"].isna() if window["k"] is None else part["k"] == window["k"]).all()
                for v in part["v"]:
                    assert last is None or v >= last
                    jumps, last = jumps + (last is not None and v > last + 5), v
                n, longest = n + len(part), max(longest, len(part))
            yield pd.DataFrame([{"k": window["k"], "n": n, "jumps": jumps, "longest": longest}])

        got = user.window_rows_apply(rows, "ts", "3 hours", ["k"], walk, "k bigint, n bigint, jumps bigint, longest bigint", ["v"]).collect()
        want = {}
        for r in rows.select("k", F.expr("unix_seconds(ts) div 10800").alias("w"), "v").collect():
            want.setdefault((r["w"], r["k"]), []).append(r["v"])
        jumps = [(k, len(v), sum(b > a + 5 for a, b in zip(sorted(v), sorted(v)[1:]))) for (_, k), v in want.items()]
        assert sorted(((r["k"], r["n"], r["jumps"]) for r in got), key=repr) == sorted(jumps, key=repr)
        assert max(r["longest"] for r in got) <= 50 and max(r["n"] for r in got) >= 1_000

        def first_only(window, pieces):
            yield next(pieces).head(1)[["id"]]

        early = user.window_rows_apply(rows, "ts", "1 hour", [], first_only, "id bigint").collect()
        assert sorted(r["id"] for r in early) == list(range(0, 5_000, 1_200))
        assert user.window_rows_apply(rows.where("false"), "ts", "1 hour", [], first_only, "id bigint").collect() == []
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("ordered", [True, False])
def test_async_lookups_are_bounded_and_overlap(spark, ordered):
    rows = spark.range(400, numPartitions=2)

    def connect():
        import threading

        return {"lock": threading.Lock(), "now": 0}

    def ask(part, service):
        import time

        with service["lock"]:
            service["now"] += 1
            seen = service["now"]
        time.sleep(0.12 if part["id"].iloc[0] % 40 == 0 else 0.01)
        with service["lock"]:
            service["now"] -= 1
        return part.assign(seen=seen)

    started = time.monotonic()
    got = lookup_async(rows, ask, "id bigint, seen int", open=connect, in_flight=5, call_rows=10, ordered=ordered).collect()
    ids = [r["id"] for r in got]
    assert sorted(ids) == list(range(400)) and (ids == sorted(ids)) == ordered
    assert 2 <= max(r["seen"] for r in got) <= 5 and time.monotonic() - started < 30


def test_async_lookups_try_again_and_give_up(spark):
    rows = spark.range(60, numPartitions=1)

    def connect():
        return {}

    def ask(part, tried):
        import time

        first = int(part["id"].iloc[0])
        tried[first] = tried.get(first, 0) + 1
        if first == 10 and tried[first] == 1:
            raise ConnectionError("try again")
        if first == 20:
            raise ConnectionError("gone")
        if first == 30 and tried[first] == 1:
            time.sleep(20)  # left to itself after the timeout
        return part.assign(found=tried[first])

    def missing(part):
        return part.assign(found=-1)

    for ordered in (True, False):
        started = time.monotonic()
        got = {r["id"]: r["found"] for r in lookup_async(rows, ask, "id bigint, found int", open=connect, in_flight=3, call_rows=10, ordered=ordered, timeout=1.0, retries=1, missing=missing).collect()}
        assert [got[k] for k in (0, 10, 20, 30, 40, 50)] == [1, 2, -1, 2, 1, 1] and len(got) == 60
        assert time.monotonic() - started < 15
    with pytest.raises(Exception, match="try again"):
        lookup_async(rows, ask, "id bigint, found int", open=connect, call_rows=10).collect()
    assert lookup_async(rows.where("false"), ask, "id bigint, found int", open=connect).collect() == []
