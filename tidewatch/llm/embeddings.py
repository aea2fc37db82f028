"""Embedding near-duplicates by sorted projection passes.

Equal vectors are one node, the smallest id among them.  Each pass draws random rotations; a
node's hash under a rotation is its longest coordinate with its sign, and its key is several
such hashes in a row.  Nodes are sorted by key and numbered over all partitions, and every block
of the order is compared with itself and the block before it by matrix products, so results do
not depend on the number of partitions.  Verified pairs are united across passes.

Two nodes whose keys agree in the first hashes always meet: where such a run is longer than two
blocks, all pairs of its blocks are compared.  How many hashes make a run grows with the rows,
so that a run of evenly spread vectors stays within a block, and the number of passes follows
from it, so that a pair at the threshold agrees in one pass with probability RECALL.

Passes ship vectors in half precision; its error is at most EPSILON in the cosine, so only
pairs that close to the threshold are looked up and decided in double precision.  A task
reports a spanning forest of the links it finds.  Links are then counted inside each
component on the full double-precision vectors, in blocks of bounded size, where a node counts
as often as its vector occurs.

Vectors that are null, empty, zero or hold null or non-finite numbers link with nothing, and
neither do vectors of different lengths.  A null id takes no part.  Rows that repeat an id each
get a row; an id with several vectors has the smallest component and the most links of them.
An empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored
from tidewatch.llm.components import components

#: probability that a pair at the threshold agrees in the first hashes of one pass at least
RECALL = 0.99
HASHES = 3
#: neighbours: a vector is compared with its block of the sorted order and the one before
BLOCK = 1024
#: bound of the cosine's error in half precision (two vectors, relative error 2^-11 each, with room)
EPSILON = 2.5e-3
SEED = 5


def unit_vectors(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, dim, vec): double-precision unit vectors as bytes, without those that cannot link."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = [], []
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                if k is None or not x.is_valid or not len(x) or x.values.null_count:
                    continue
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                top = np.abs(v).max()
                if np.isfinite(top) and top > 0:
                    v = v / top
                    ids.append(k)
                    vectors.append(v / np.linalg.norm(v))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(v) for v in vectors], pa.int32()), pa.array([v.tobytes() for v in vectors], pa.binary())],
                ["id", "dim", "vec"],
            )

    return rows.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v")).mapInArrow(task, "id long, dim int, vec binary")


def rotations(dim: int, turn: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim, turn]).standard_normal((HASHES, dim, dim)).astype(np.float32)


def agreement(dim: int, cosine: float, draws: int = 20_000) -> float:
    """Probability that one hash agrees for two vectors of this cosine, by drawing pairs.

    A Gaussian matrix turns such a pair into Gaussian coordinates of that correlation.
    """
    rng = np.random.default_rng([SEED, dim])
    same, left = 0, draws
    while left:
        n = min(left, max(1, 1_000_000 // dim))
        x, noise = rng.standard_normal((2, n, dim), dtype=np.float32)
        y = cosine * x + np.sqrt(max(0.0, 1 - cosine**2)) * noise
        a, b, rows = np.abs(x).argmax(axis=1), np.abs(y).argmax(axis=1), np.arange(n)
        same += int(((a == b) & (x[rows, a] * y[rows, a] > 0)).sum())
        left -= n
    return max(same, 1) / draws


def plan(dim: int, nodes: int, cosine: float, block: int = BLOCK) -> tuple[int, int]:
    """(hashes of a run, passes) for so many vectors of a length."""
    hashes = 1
    while hashes < HASHES and nodes > block * (2 * dim) ** hashes:
        hashes += 1
    agree = agreement(dim, cosine) ** hashes
    return hashes, 1 if agree >= RECALL else math.ceil(math.log(1 - RECALL) / math.log1p(-agree))


def keyed(vectors: DataFrame, turn: int, plans: dict[int, tuple[int, int]]) -> DataFrame:
    """(dim, place, run, id): the key of a pass and its first hashes, for lengths that this pass is for."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                hashes, passes = plans[dim]
                if turn >= passes:
                    continue
                part = batch.filter(pa.array(dims == dim))
                v = np.frombuffer(b"".join(part.column(2).to_pylist()), dtype=np.float64).reshape(-1, dim).astype(np.float32)
                turned = drawn.setdefault(dim, rotations(dim, turn))
                place = np.zeros(len(v), dtype=np.int64)
                for rotation in turned:
                    w = v @ rotation
                    top = np.abs(w).argmax(axis=1)
                    place = place * (2 * dim) + 2 * top + (w[np.arange(len(w)), top] < 0)
                run = place // (2 * dim) ** (HASHES - hashes)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(place), pa.array(run), part.column(0)], ["dim", "place", "run", "id"])

    return vectors.mapInArrow(task, "dim int, place long, run long, id long")


def halves(vectors: DataFrame) -> DataFrame:
    """(id, half): the vectors in half precision."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = [np.frombuffer(x).astype(np.float16).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(half, pa.binary())], ["id", "half"])

    return vectors.select("id", "vec").mapInArrow(task, "id long, half binary")


def numbered(ordered: DataFrame) -> tuple[DataFrame, int]:
    """(dim, run, id, rank) with ranks from 0 over all sorted partitions, and the number of rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(np.full(n, part, dtype=np.int32)), pa.array(np.arange(done, done + n, dtype=np.int64))],
                ["dim", "run", "id", "part", "at"],
            )
            done += n

    placed = stored(ordered.mapInArrow(task, "dim int, run long, id long, part int, at long"), "order")
    starts, total = [], 0
    for r in placed.groupBy("part").count().orderBy("part").collect():
        starts.append((r["part"], total))
        total += r["count"]
    first = ordered.sparkSession.createDataFrame(starts, "part int, first long")
    return placed.join(F.broadcast(first), "part").select("dim", "run", "id", (F.col("first") + F.col("at")).alias("rank")), total


def met(ranked: DataFrame, half: DataFrame, total: int, parts: int, block: int = BLOCK) -> DataFrame:
    """(task, other, rank, dim, id, half) sorted: blocks in a row with the one before, and far blocks of one run.

    ``other`` is -1 for the blocks in a row.
    """
    at = ranked.withColumn("block", F.floor(F.col("rank") / block))
    across = max(1, math.ceil(total / block / parts))  # blocks a task walks
    mine = F.floor(F.col("block") / across)
    in_rows = F.array(mine, F.when((F.col("block") + 1) % across == 0, mine + 1))
    rows = at.withColumn("task", F.explode(F.filter(in_rows, lambda x: x.isNotNull()))).select("task", F.lit(-1).cast("long").alias("other"), "rank", "dim", "id")
    runs = stored(at.groupBy("dim", "run").agg(F.min("block").alias("low"), F.max("block").alias("high")).where("high > low + 1"), "runs")
    if not runs.isEmpty():
        pairs = runs.select(F.explode(F.sequence("low", F.col("high") - 2)).alias("i"), "high").select("i", F.explode(F.sequence(F.col("i") + 2, "high")).alias("j")).distinct()
        sides = pairs.select("i", "j", F.explode(F.array("i", "j")).alias("block"))
        rows = rows.unionByName(at.join(sides, "block").select(F.col("i").alias("task"), F.col("j").alias("other"), "rank", "dim", "id"))
    return rows.join(half, "id").select("task", "other", "rank", "dim", "id", "half").repartition(parts, "task", "other").sortWithinPartitions("task", "other", "rank")


def forest_edges(near: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric boolean matrix."""
    waiting = near.any(axis=1)
    edges: list[tuple[int, int]] = []
    while waiting.any():
        front = np.array([int(waiting.argmax())])
        waiting[front] = False
        while len(front):
            reached = np.flatnonzero(near[front].any(axis=0) & waiting)
            if len(reached):
                edges += zip(front[near[np.ix_(front, reached)].argmax(axis=0)].tolist(), reached.tolist())
                waiting[reached] = False
            front = reached
    return edges


def neighbour_links(ordered: DataFrame, cosine: float, block: int = BLOCK) -> DataFrame:
    """(a, b, sure) among the blocks that meet; unsure pairs are close to the threshold."""

    def block_links(ids: np.ndarray, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
        product = vectors @ vectors.T
        np.fill_diagonal(product, -1)
        sure = product >= cosine + EPSILON
        close = np.triu(product >= cosine - EPSILON) & ~sure
        pairs = forest_edges(sure) if sure.any() else []
        a, b = (np.array(x, dtype=np.int64) for x in (zip(*pairs) if pairs else ((), ())))
        c, d = np.nonzero(close)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([ids[a], ids[c]])), pa.array(np.concatenate([ids[b], ids[d]])), pa.array(np.arange(len(a) + len(c)) < len(a))], ["a", "b", "sure"]
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[tuple, np.ndarray, np.ndarray] | None = None
        held: list[tuple[int, bytes]] = []
        place: tuple = ()  # task, other, dim, block

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal before
            ids = np.array([r[0] for r in held], dtype=np.int64)
            vectors = np.frombuffer(b"".join(r[1] for r in held), dtype=np.float16).reshape(-1, place[2]).astype(np.float32)
            if before is not None and before[0] == place[:3]:
                yield from block_links(np.concatenate([before[1], ids]), np.concatenate([before[2], vectors]))
            else:
                yield from block_links(ids, vectors)
            before = (place[:3], ids, vectors)

        for batch in batches:
            for work, other, rank, dim, vec_id, half in zip(*(batch.column(k).to_pylist() for k in range(6))):
                here = (work, other, dim, rank // block)
                if held and here != place:
                    yield from close()
                    held = []
                place = here
                held.append((vec_id, half))
        if held:
            yield from close()

    return ordered.mapInArrow(task, "a long, b long, sure boolean")


#: products this near to the threshold are taken again, one pair at a time
DOUBT = 1e-9


def reaches(x: np.ndarray, y: np.ndarray, cosine: float) -> bool:
    """The one test of two unit vectors in double precision; sums of products are rounded once."""
    return math.fsum((x * y).tolist()) >= cosine


def dots(frame: DataFrame, cosine: float) -> DataFrame:
    """Pairs whose double-precision cosine reaches the threshold."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [
                len(x) == len(y) and reaches(np.frombuffer(x), np.frombuffer(y), cosine)
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return frame.select("a", "b", "vec_a", "vec_b").mapInArrow(task, "a long, b long")


def link_counts(nodes: DataFrame, labels: DataFrame, cosine: float) -> DataFrame:
    """(rep, label, dim, vec, links): per distinct vector of a component, how many rows it links."""
    nodes = nodes.join(labels, nodes["id"] == labels["node"]).select("label", "dim", "vec", F.col("id").alias("rep"), "rows")
    nodes = stored(nodes, "nodes")
    sizes = nodes.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = nodes.join(sizes, "label").withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rep", "rows", "dim", "vec"
    )
    ordered = dealt.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "dim")

    def counted(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        label, i, j, dim, mine, rep, times = (rows.column(c).to_numpy() for c in ("label", "i", "j", "dim", "mine", "rep", "rows"))
        change = np.flatnonzero((label[1:] != label[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]) | (dim[1:] != dim[:-1])) + 1
        raw = rows.column("vec").to_pylist()
        for start, stop in zip(np.concatenate([[0], change]), np.append(change, len(rep))):
            v = np.frombuffer(b"".join(raw[start:stop]), dtype=np.float64).reshape(stop - start, -1)
            products = v @ v.T
            near = products >= cosine
            for a, b in zip(*np.nonzero(np.abs(products - cosine) <= DOUBT)):
                near[a, b] = reaches(v[a], v[b], cosine)
            if i[start] != j[start]:  # rows of one block meet in that block's own pair
                near &= mine[start:stop][:, None] != mine[start:stop][None, :]
            yield pa.RecordBatch.from_arrays([pa.array(rep[start:stop]), pa.array(near @ times[start:stop])], ["rep", "links"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
            label, i, j = (rows.column(c).to_numpy() for c in ("label", "i", "j"))
            other = np.flatnonzero((label != label[-1]) | (i != i[-1]) | (j != j[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            held = rows.slice(cut)
            if cut:
                yield from counted(rows.slice(0, cut).combine_chunks())
        if held is not None:
            yield from counted(held)

    links = ordered.mapInArrow(task, "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))
    return nodes.select("rep", "label", "dim", "vec").join(links, "rep")


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = 0.9, block: int = BLOCK) -> DataFrame:
    """Per vector: the id, n_links, component_id (smallest id reachable by links) and kept."""
    vectors = stored(unit_vectors(rows, vec_id, embedding), "vectors")
    nodes = stored(vectors.groupBy("dim", "vec").agg(F.min("id").alias("id"), F.count("*").alias("rows")).select("id", "dim", "vec", "rows"), "distinct")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plans = {r["dim"]: plan(r["dim"], r["count"], cosine, block) for r in nodes.groupBy("dim").count().collect()}
    half = halves(nodes)
    found = None
    for turn in range(max((passes for _, passes in plans.values()), default=1)):
        ordered = keyed(nodes, turn, plans).repartitionByRange(parts, "dim", "place", "id").sortWithinPartitions("dim", "place", "id")
        ranked, total = numbered(ordered)
        links = stored(neighbour_links(met(ranked, half, total, parts, block), cosine, block), "links")
        found = links if found is None else found.union(links)
    unsure = found.where("not sure").select("a", "b").distinct()
    full_a = nodes.select(F.col("id").alias("a"), F.col("vec").alias("vec_a"))
    full_b = nodes.select(F.col("id").alias("b"), F.col("vec").alias("vec_b"))
    decided = dots(unsure.join(full_a, "a").join(full_b, "b"), cosine)
    labels = components(found.where("sure").select("a", "b").union(decided))

    counts = link_counts(nodes, labels, cosine).select("dim", "vec", "label", "links")
    alone = nodes.where("rows > 1").join(labels, nodes["id"] == labels["node"], "left_anti")
    counts = counts.union(alone.select("dim", "vec", F.col("id").alias("label"), F.col("rows").alias("links")))
    linked = vectors.join(counts, ["dim", "vec"]).groupBy("id").agg(F.min("label").alias("label"), F.max("links").alias("links"))
    out = rows.select(F.col(vec_id).cast("long").alias("__id")).join(linked, F.col("__id") == F.col("id"), "left")
    component = F.coalesce("label", "__id")
    return out.select(
        F.col("__id").alias(vec_id),
        (F.coalesce("links", F.lit(1).cast("long")) - 1).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("__id") == component, F.lit(True)).alias("kept"),
    )
