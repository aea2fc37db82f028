"""Rendezvous shards: shares, moves and slots."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import compare
from conftest import MEDIUM
from tidewatch.llm import queries, sharding


def winner(key, weights):
    def score(s):
        drawn = (int(hashlib.md5(f"{s}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        return -weights[s] / math.log(drawn)

    return max((s for s in range(len(weights)) if weights[s]), key=lambda s: (score(s), -s))


def test_shards_follow_the_weights(spark):
    weights = [1, 2, 0, 0.5, 4]
    rows = sharding.with_shard(spark.range(20_000).withColumnRenamed("id", "k"), "k", weights).collect()
    assert all(r["shard"] == winner(r["k"], weights) for r in rows[:2000])
    counts = Counter(r["shard"] for r in rows)
    for s, w in enumerate(weights):
        assert abs(counts[s] - 20_000 * w / 7.5) < 5 * math.sqrt(20_000 * w / 7.5) + 1


def test_changes_move_few_records(spark):
    keys = spark.range(9000).withColumnRenamed("id", "k")
    rows = sharding.with_shard(sharding.with_shard(sharding.with_shard(keys, "k", [1] * 8, "a"), "k", [1] * 9, "b"), "k", [1, 1, 1, 0, 1, 1, 1, 1], "c")
    rows = sharding.with_shard(rows, "k", [1, 3, *[1] * 6], "d").collect()
    assert all(r["b"] in (r["a"], 8) and (r["a"] == 3 or r["c"] == r["a"]) and r["d"] in (r["a"], 1) for r in rows)
    assert abs(sum(r["b"] == 8 for r in rows) - 1000) < 150 and all(r["c"] != 3 for r in rows)


@pytest.mark.parametrize("bad", [[], [0, 0], [1, -1], [float("inf"), 1], [float("nan")]])
def test_bad_weights(spark, bad):
    with pytest.raises(ValueError):
        sharding.with_shard(spark.range(1), "id", bad)


def test_slots_of_odd_rows(spark, scratch):
    rows = [(None, "a", "x")] * 3 + [(7, None, "x"), (7, "", "y"), (7, "é", "x"), (7, "é", "x"), (-5, "long " * 600_000, "x")] + [(k, "t", "z") for k in range(100, 400)] + [(5, "hot", "h")] * 200
    docs = spark.createDataFrame([(*r, 1, "s", 9) for r in rows], "doc_id long, text string, source string, slot int, shard string, size long").repartition(7)
    docs.write.parquet(f"{scratch}/documents.parquet")
    got = queries.op12_shards(spark, scratch)
    assert compare.compare(got, compare_documents(scratch), queries.SQL["op12_shards"])[1] is None
    slots = defaultdict(list)
    for r in got.collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == len(rows)
    empty = sharding.with_slot(sharding.with_shard(docs.limit(0), "doc_id", [1]), order=["doc_id"])
    assert empty.collect() == [] and set(empty.columns) == set(docs.columns)


def compare_documents(folder):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return con


def test_slots_do_not_depend_on_partitions(spark):
    table, before, got = sharding.with_shard(spark.range(500).withColumnRenamed("id", "doc_id"), "doc_id", [1, 1, 9]), spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got.append({tuple(r) for r in sharding.with_slot(table.repartition(int(parts) + 2)).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]


def test_written_shards(spark, scratch):
    rows = sharding.with_slot(sharding.with_shard(spark.range(300).withColumnRenamed("id", "doc_id"), "doc_id", [1] * 4))
    sharding.write_shards(rows, f"{scratch}/shards")
    back = spark.read.parquet(f"{scratch}/shards")
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in back.collect()} == {(r["doc_id"], r["shard"], r["slot"]) for r in rows.collect()}
    assert back.where(F.col("shard") == 2).select(F.count_distinct("slot") == F.max("slot") + 1).first()[0]


def test_query_against_sql(spark):
    assert compare.compare(queries.op12_shards(spark, MEDIUM), compare.connect(MEDIUM), queries.SQL["op12_shards"]) == (1000, None)
