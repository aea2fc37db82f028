"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns (role and text); conversations that start with it
are its members.  Turns are numbered per conversation over range partitions, and a prefix is
known by the running sums of hashes of its turns, each taken with its place (four sums of 32
bits, so a prefix's identity is a hash of some 128 bits).  A turn's own share taken off gives
the parent's sums, so no step runs once per depth and no conversation has to fit into a task.

Totals over subtrees come from contraction in rounds of joins.  A round rakes all leaves into
their parents, and compresses chains: of nodes with one child, an independent set is cut out,
what they hold going to the edge of their child.  Which nodes of a chain go is told by the
lowest bit in which the depths of a node and its present parent differ (on an evenly spaced
chain that is every second node), in every fourth round by hashes of the ids, so rounds grow
with the logarithm of the tree.  A raked node's total is
known when it goes; the nodes cut out get theirs when the rounds are undone, last one first:
what they held plus the total of the child they had.  Each round is written to the shared
folder.  Sums over children combine before the shuffle, joins are on node ids, which are
unique, and the one join on parents sends the parents of many children (a thousand at most)
by broadcast, so a node may have any number of children.

Order is by turn, null first; ties by role, then text.  A null role or text is empty.  Rows
without a conversation id belong to none and are left out; repeated rows are turns of their
own.  An empty table without further members has no nodes, not even a root.  Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import dropped, looked_up, numbered_within, stored

#: turns of one conversation summed in one group
STRETCH = 4096
SUMS = ("s0", "s1", "s2", "s3")
WORD = r"[^\x20\x09-\x0D]+"


class Trie(NamedTuple):
    """``nodes``: key, parent (null for the root), depth, conv_id, n_convs, words, n_children;
    ``ends``: key, conv_id, one row per conversation at the node of its whole sequence."""

    nodes: DataFrame
    ends: DataFrame


def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, at, role, text): the turns of each conversation numbered from 0."""
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    return numbered_within(rows, ["conv_id"], ["turn", "role", "text"], "at").select("conv_id", "at", "role", "text")


def turn_sums() -> list[Column]:
    """Four 32-bit hashes of a turn at its place."""
    a, b = (F.xxhash64(F.lit(seed), "at", "role", "text") for seed in (1, 2))
    low = F.lit(0xFFFFFFFF)
    return [a.bitwiseAND(low), F.shiftrightunsigned(a, 32), b.bitwiseAND(low), F.shiftrightunsigned(b, 32)]


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, key, parent, words) of every first d turns, d from 1, of numbered turns."""
    hashed = rows.withColumns(dict(zip(SUMS, turn_sums()))).withColumn("words", F.regexp_count("text", F.lit(WORD)).cast("long"))
    hashed = hashed.select("conv_id", "at", "words", *SUMS).withColumn("stretch", F.floor(F.col("at") / STRETCH))
    so_far = Window.partitionBy("conv_id", "stretch").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    summed = hashed.withColumns({f"{s}_up": F.sum(s).over(so_far) for s in SUMS})
    stretches = hashed.groupBy("conv_id", "stretch").agg(*(F.sum(s).alias(s) for s in SUMS))
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = stretches.select("conv_id", "stretch", *(F.sum(s).over(before).alias(f"{s}_before") for s in SUMS)).where("stretch > 0")
    joined = summed.join(carried, ["conv_id", "stretch"], "left")
    whole = [F.col(f"{s}_up") + F.coalesce(f"{s}_before", F.lit(0)) for s in SUMS]
    return joined.select(
        "conv_id",
        (F.col("at") + 1).alias("depth"),
        key_of(whole, F.col("at") + 1).alias("key"),
        key_of([w - F.col(s) for w, s in zip(whole, SUMS)], F.col("at")).alias("parent"),
        "words",
    )


def key_of(sums: Sequence[Column], depth: Column) -> Column:
    return F.md5(F.concat_ws(",", *(s.cast("string") for s in sums), depth.cast("string")).cast("binary"))


def build(rows: DataFrame, members: DataFrame | None = None) -> Trie:
    """The trie of numbered turns; ``members`` (conv_id) may name conversations without turns."""
    steps = stored(prefixes(rows), "prefixes")
    ended = steps.groupBy("conv_id").agg(F.max_by("key", "depth").alias("key"))
    everyone = ended.select("conv_id") if members is None else ended.select("conv_id").union(members.where("conv_id is not null").select("conv_id")).distinct()
    root = key_of([F.lit(0)] * len(SUMS), F.lit(0))
    top = everyone.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = top.select(root.alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("words"))
    met = steps.groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("words").alias("words")
    )
    bare = stored(top.unionByName(met), "nodes")
    children = bare.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = stored(bare.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    dropped(bare)
    ends = everyone.join(ended, "conv_id", "left").select(F.coalesce("key", root).alias("key"), "conv_id")
    return Trie(nodes, ends)


def contract(active: DataFrame, values: Sequence[str], turn: int) -> DataFrame:
    """One round over (id, parent, depth, above, *values, *edge values): what becomes of each node.

    ``above`` is the depth of the present parent.

    ``fate`` is rake (a leaf: its values are its totals), splice (cut out of a chain: ``child``
    is the child it had, ``held_*`` what it and the edge to that child held) or stay.
    """
    differ = F.col("depth").bitwiseXOR(F.col("above"))
    coin = F.col("depth").bitwiseAND(differ).bitwiseAND(-differ) != 0 if turn % 4 < 3 else F.xxhash64("id", F.lit(turn)).bitwiseAND(F.lit(1)) == 1
    counts = active.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n"))
    known = active.join(counts, "id", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("coin", coin)
    known = known.withColumn("unary", F.expr("n = 1 and parent is not null"))
    leaf, inner = F.col("n") == 0, F.col("n") > 0
    below = known.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(
        *(F.sum(F.when(leaf, F.col(v) + F.col(f"edge_{v}"))).alias(f"raked_{v}") for v in values),
        F.count(F.when(inner, 1)).alias("inner"),
        F.max(F.when(inner, F.col("id"))).alias("child"),
        F.max(F.when(inner, F.col("unary") & F.col("coin"))).alias("child_goes"),
        *(F.max(F.when(inner, F.col(f"edge_{v}"))).alias(f"below_{v}") for v in values),
    )
    met = known.join(below, "id", "left")
    spliced = F.expr("unary and inner = 1 and coin and not child_goes")
    fate = F.when(F.expr("n = 0 and parent is not null"), "rake").when(spliced, "splice").otherwise("stay")
    return met.select(
        "id", "parent", "depth", "above", fate.alias("fate"),
        *((F.col(v) + F.coalesce(f"raked_{v}", F.lit(0))).alias(v) for v in values),
        *(f"edge_{v}" for v in values),
        "child",
        *((F.col(v) + F.col(f"below_{v}")).alias(f"held_{v}") for v in values),
    )


def subtree_totals(nodes: DataFrame, values: Sequence[str]) -> DataFrame:
    """(id, *values summed over the node's subtree, itself included).

    ``nodes`` has a unique id, parent (null for a root; there may be several), depth and values.
    """
    above = F.when(F.col("parent").isNotNull(), F.col("depth") - 1).alias("above")
    active = nodes.select("id", "parent", "depth", above, *values, *(F.lit(0).cast("long").alias(f"edge_{v}") for v in values))
    rounds: list[DataFrame] = []
    while True:
        done = stored(contract(active, values, len(rounds)), "round")
        rounds.append(done)
        if done.where("fate = 'stay' and parent is not null").isEmpty():
            break
        cut = done.where("fate = 'splice'").select(
            F.col("child").alias("id"), F.col("parent").alias("higher"), F.col("above").alias("higher_depth"), *((F.col(v) + F.col(f"edge_{v}")).alias(f"cut_{v}") for v in values)
        )
        active = done.where("fate = 'stay'").join(cut, "id", "left").select(
            "id", F.coalesce("higher", "parent").alias("parent"), "depth", F.coalesce("higher_depth", "above").alias("above"), *values,
            *((F.col(f"edge_{v}") + F.coalesce(f"cut_{v}", F.lit(0))).alias(f"edge_{v}") for v in values),
        )
    columns = ["id", *values]
    totals = rounds[-1].where("fate <> 'splice'").select(columns)
    made: list[DataFrame] = []
    for k in range(len(rounds) - 2, -1, -1):
        wanted = rounds[k].where("fate = 'splice'").select("id", "child", *(f"held_{v}" for v in values))
        below = totals.select(F.col("id").alias("child"), *values)
        grown = stored(wanted.join(below, "child").select("id", *((F.col(f"held_{v}") + F.col(v)).alias(v) for v in values)), "grown")
        made.append(grown)
        totals = totals.union(grown).union(rounds[k].where("fate = 'rake'").select(columns))
    whole = stored(totals, "totals")
    for table in (*rounds, *made):
        dropped(table)
    return whole


def with_totals(trie: Trie) -> DataFrame:
    """The nodes with parent_conv_id, n_leaves (childless nodes in the subtree) and saved_tokens
    (over the subtree, each node's members but one, times the words of its last text)."""
    nodes = trie.nodes
    valued = nodes.select(
        F.col("key").alias("id"), "parent", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    )
    totals = subtree_totals(valued, ["n_leaves", "saved_tokens"])
    parents = nodes.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = looked_up(nodes, parents, "parent")
    return named.join(totals.withColumnRenamed("id", "key"), "key").select(*nodes.columns, "parent_conv_id", "n_leaves", "saved_tokens")


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the decimal ids that end at a node, ascending, by commas.

    A digest is one pass over its ids, which cannot be divided; they stream through a task in
    order, two narrow columns, and only the hash's state is held.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            start, out = 0, []
            while start < len(keys):
                stop = start + 1
                while stop < len(keys) and keys[stop] == keys[start]:
                    stop += 1
                part = ",".join(map(str, ids[start:stop])).encode()
                if keys[start] == now:
                    state.update(b"," + part)
                else:
                    if now is not None:
                        out.append((now, state.hexdigest()))
                    now, state = keys[start], hashlib.sha256(part)
                start = stop
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out]), pa.array([r[1] for r in out])], ["key", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    return ends.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "conv_id").mapInArrow(task, "key string, ends_sha256 string")


def rebuilt(rows: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Numbered turns in which conversations share openings, and all conversation ids.

    The first h turns of conversation c become those of conversation c - c % every (as many as
    it has), h = crc32 of the decimal c modulo ``most``; the turns after c's first h follow.
    """
    convs = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = convs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = stored(convs.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))), "openings")
    heads = rows.where(F.col("at") < most - 1).where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), "at", "role", "text")
    opening = convs.select("conv_id", "base", "taken").join(heads, "base").where("at < taken").select("conv_id", "at", "role", "text")
    own = rows.join(convs.select("conv_id", "h", "taken"), "conv_id").where("at >= h").select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "role", "text")
    return opening.union(own), convs.select("conv_id")
