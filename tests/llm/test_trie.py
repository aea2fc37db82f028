"""Prefix trie and tree contraction against plain walks."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import compare
from conftest import MEDIUM
from tidewatch.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, at string"


def brute(rows, extra=()):
    """Every node of the trie by its prefix, from the definition."""
    convs = {c: [] for c in extra}
    for c, *turn in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn[0] is not None, turn[0] or 0, turn[1] or "", turn[2] or ""))
    seqs = {c: tuple((r, t) for _, _, r, t in sorted(turns)) for c, turns in convs.items()}
    members = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {p: [x for x in members if len(x) == len(p) + 1 and x[: len(p)] == p] for p in members}
    out = set()
    for p, cs in members.items():
        below = [x for x in members if x[: len(p)] == p]
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x)
        ends = ",".join(str(c) for c in sorted(cs) if seqs[c] == p)
        out.add((
            min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]), sum(not children[x] for x in below), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def ours(table, members=None):
    tree = trie.build(trie.numbered(table), members)
    nodes = trie.with_totals(tree).join(trie.end_digests(tree.ends), "key", "left")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    got = nodes.select(*names, F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256))).collect()
    assert len({tuple(r) for r in got}) == len(got)
    return {tuple(r) for r in got}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 3, "x") for r in rows], SCHEMA)


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "Hello there"), (1, 1, "assistant", "Hi"), (1, 2, "user", "a b\tc"), (2, 0, "user", "Hello there"), (2, 1, "assistant", "Hi"),
        (3, None, None, None), (3, 0, "", "x"), (4, None, "", ""), (4, 0, None, "x"), (5, 1, "b", "t"), (5, 1, "a", "t"), (6, 1, "a", "t"), (6, 1, "b", "t"),
        (7, 0, "user", "same"), (7, 0, "user", "same"), (8, 0, "user", "same"), (None, 0, "user", "lost"), (9, -3, "us", "er"), (10, 5, "u", "ser"),
        (-11, 0, "user", "Hello there"), (12, 0, "user", "w " * 30_000),
    ]
    assert ours(frame(spark, rows)) == brute(rows)
    extra = spark.createDataFrame([(100,), (1,), (None,)], "conv_id long")
    assert ours(frame(spark, rows), extra) == brute(rows, [100])


def test_empty_table(spark):
    assert ours(frame(spark, [])) == set()
    assert ours(frame(spark, []), spark.createDataFrame([(4,), (2,)], "conv_id long")) == brute([], [4, 2])


def test_long_and_many_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "STRETCH", 7)
    rng = random.Random(3)
    rows = [(c, t, "user", rng.choice("ab") if t else "go") for c in range(120) for t in range(rng.randrange(12))]
    rows += [(1000, t, "user", "go" if t == 0 else "a") for t in range(60)] + [(c, 0, "user", f"alone {c}") for c in range(2000, 2100)]
    assert ours(frame(spark, rows)) == brute(rows)


def test_one_conversation_over_many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        table = spark.range(3000).select(F.lit(7).alias("conv_id"), F.expr("id div 2").alias("turn"), F.lit("u").alias("role"), F.expr("cast(id % 5 as string)").alias("text"))
        rows = trie.numbered(table).orderBy("at").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r["at"] for r in rows] == list(range(3000))
    assert [r["text"] for r in rows] == [x for k in range(0, 3000, 2) for x in sorted((str(k % 5), str((k + 1) % 5)))]


@pytest.mark.parametrize("shape", ["chain", "star", "random", "comb", "forest"])
def test_contraction(spark, shape, monkeypatch):
    rng, n = random.Random(shape), 300
    parent = {
        "chain": lambda k: k - 1, "star": lambda k: 0, "random": lambda k: rng.randrange(k), "comb": lambda k: k - 1 if k % 2 else max(k - 2, 0),
        "forest": lambda k: None if k % 50 == 0 else rng.randrange(k - k % 50, k),
    }[shape]
    up = {0: None, **{k: parent(k) for k in range(1, n)}}
    depth, value = {}, {k: rng.randrange(1000) for k in up}
    for k in up:
        depth[k] = 0 if up[k] is None else depth[up[k]] + 1
    rows = [(str(k), None if p is None else str(p), depth[k], value[k], 1) for k, p in up.items()]
    calls = []
    inner = trie.contract
    monkeypatch.setattr(trie, "contract", lambda *a: calls.append(1) or inner(*a))
    got = trie.subtree_totals(spark.createDataFrame(rows, "id string, parent string, depth long, a long, b long"), ["a", "b"]).collect()
    a, b = dict(value), dict.fromkeys(up, 1)
    for k in sorted(up, key=depth.get, reverse=True):
        if up[k] is not None:
            a[up[k]] += a[k]
            b[up[k]] += b[k]
    assert {int(r["id"]): (r["a"], r["b"]) for r in got} == {k: (a[k], b[k]) for k in up} and len(got) == n
    assert len(calls) <= 14  # rounds follow the logarithm of 300


def test_query_against_sql(spark):
    query = queries.op13_prefix_trie(spark, MEDIUM)
    rows, why = compare.compare(query, compare.connect(MEDIUM), queries.SQL["op13_prefix_trie"])
    assert why is None and rows > 300
