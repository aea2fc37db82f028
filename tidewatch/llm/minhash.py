"""Near-duplicate documents by SetSketch registers, banding and verification on full sets.

A document is the set of its distinct word shingles.  Each of 128 registers keeps the smallest
exponential draw over the set, truncated to a power of BASE: registers of two sets merge by
maximum, and equal registers are a locality-sensitive signal.  Documents with one and the same
set are one node from the start, so exact copies cost nothing later.  Nodes that share a band
of four registers are candidates; at the link threshold of 0.8 a pair misses all 32 bands
with probability 5e-8.

Candidates are not expanded into all pairs of a bucket.  Every node is first tested against
the smallest node of its buckets.  Only buckets whose nodes then still lie in different
components are compared across components, in blocks of bounded size: likely links join
nodes to families, and families are compared again, in blocks, on full sets.  A candidate
pair's similarity is estimated by maximum likelihood from how many registers are larger,
smaller and equal; pairs estimated well below the threshold go, every other pair across
components is tested on its full sets.

Null and blank texts have an empty set and are linked with nothing.  A null id takes no part
in linking: its component is null and it is kept.  Rows with the same id are one node.  Other
columns are not looked at, an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import LOWER, TEXT_ROWS, dropped, find_words, mix64, pieces, segment_hashes, stored, text_bytes
from tidewatch.llm.components import components

REGISTERS = 128
ROWS = 4
BANDS = REGISTERS // ROWS
BASE = 1.001
#: below the threshold by this much, a likelihood estimate rules a pair out (over 5 deviations)
SLACK = 0.2
#: nodes of a bucket compared at once, bytes of their sets, and pairs looked at together
BLOCK = 2048
BLOCK_BYTES = 8_000_000
PAIRS = 50_000
#: rows of an Arrow batch where a row holds one or two whole sets
SET_ROWS = 500


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle."""
    width = min(size, len(words))
    if not width:
        return words
    mixed = np.full(len(words) - width + 1, np.uint64(width), dtype=np.uint64)
    for k in range(width):
        mixed = mix64(mixed + words[k : len(words) - width + 1 + k])
    return np.unique(mixed)


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The shingle set of each row's whole text, A-Z in lower case."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, lengths, bounds = find_words(data, offsets)
    words = segment_hashes(data, starts, lengths)
    return [shingle_hashes(words[a:b], size) for a, b in zip(bounds[:-1], bounds[1:])]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers (int16) of non-empty sets, one row each."""
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    items = np.concatenate(sets)
    seeds = mix64(np.arange(2 * REGISTERS, dtype=np.uint64))
    out = np.empty((len(sets), REGISTERS), dtype=np.int16)
    for j in range(REGISTERS):
        lowest = np.minimum.reduceat(items * (seeds[2 * j] | np.uint64(1)) + seeds[2 * j + 1], starts)
        draw = -np.log1p(-(lowest.astype(np.float64) + 0.5) / 2.0**64 + 1e-17)
        out[:, j] = np.clip(np.floor(1 - np.log(np.maximum(draw, 1e-30)) / np.log(BASE)), -32768, 32767)
    return out


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """(rows, BANDS) 64-bit keys; the band's number is part of its key."""
    packed = np.ascontiguousarray(sketch).view(np.uint64).reshape(len(sketch), BANDS)
    return mix64(mix64(packed) + np.arange(BANDS, dtype=np.uint64))


def likely_similarity(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from register comparisons and set sizes."""
    equal = REGISTERS - larger - smaller
    u = n_a / (n_a + n_b)
    v = 1 - u
    c = (BASE - 1) / BASE

    def share(x):
        return -np.log1p(-np.clip(x, 0, 1) * c) / np.log(BASE)

    def slope(j):
        up, down = np.maximum(share(u - v * j), 1e-12), np.maximum(share(v - u * j), 1e-12)
        d_up = -v * c / (1 - np.clip(u - v * j, 0, 1) * c) / np.log(BASE)
        d_down = -u * c / (1 - np.clip(v - u * j, 0, 1) * c) / np.log(BASE)
        same = np.maximum(1 - up - down, 1e-12)
        return larger * d_up / up + smaller * d_down / down - equal * (d_up + d_down) / same

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(24):
        middle = (low + high) / 2
        rising = slope(middle) > 0
        low, high = np.where(rising, middle, low), np.where(rising, high, middle)
    return (low + high) / 2


def sketched(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """id, n (set size), two sums that identify the set, sketch (null for an empty set)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "__text"):
            sets = shingle_sets(piece.column(1), size)
            some = [k for k, s in enumerate(sets) if len(s)]
            sketch: list[bytes | None] = [None] * len(sets)
            if some:
                rows = registers([sets[k] for k in some])
                for k, row in zip(some, rows):
                    sketch[k] = row.tobytes()
            first = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
            second = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(first), pa.array(second), pa.array(sketch, pa.binary())],
                ["id", "n", "sum_a", "sum_b", "sketch"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("__text"))
    return rows.mapInArrow(task, "id long, n long, sum_a long, sum_b long, sketch binary")


def bands(sets: DataFrame) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sketch = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int16).reshape(-1, REGISTERS)
            keys = band_keys(sketch).view(np.int64)
            ids = np.repeat(batch.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], ["key", "rep"])

    return sets.select("rep", "sketch").mapInArrow(task, "key long, rep long")


def full_sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(rep, items): the whole set of each wanted node, 8 bytes an item."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "__text"):
            items = [s.tobytes() for s in shingle_sets(piece.column(1), size)]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(items, pa.binary())], ["rep", "items"])

    rows = docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("__text"))
    return rows.join(wanted, "rep", "left_semi").mapInArrow(task, "rep long, items binary")


def estimated(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (x, y) whose likelihood estimate does not rule out the threshold."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.int16).reshape(-1, REGISTERS) for k in (3, 5))
            n_a, n_b = (batch.column(k).to_numpy().astype(np.float64) for k in (2, 4))
            near = likely_similarity((a > b).sum(axis=1), (a < b).sum(axis=1), n_a, n_b)
            yield batch.select([0, 1]).filter(pa.array(near >= threshold - SLACK))

    x = sets.select(F.col("rep").alias("x"), F.col("n").alias("n_x"), F.col("sketch").alias("sketch_x"))
    y = sets.select(F.col("rep").alias("y"), F.col("n").alias("n_y"), F.col("sketch").alias("sketch_y"))
    sized = pairs.join(x, "x").join(y, "y").where(f"least(n_x, n_y) >= {threshold} * greatest(n_x, n_y) - 1")
    return sized.select("x", "y", "n_x", "sketch_x", "n_y", "sketch_y").mapInArrow(task, "x long, y long")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets satisfy 100 * intersection >= percent * union."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def confirmed(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets satisfy 100 * intersection >= percent * union."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = ([np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in batch.column(k)] for k in (2, 3))
            linked = [similar(x, y, percent) for x, y in zip(a, b)]
            yield batch.select([0, 1]).filter(pa.array(linked))

    # the side that may be hot is joined while rows are narrow
    x = pairs.join(items.select(F.col("rep").alias("x"), F.col("items").alias("items_x")), "x")
    full = x.join(items.select(F.col("rep").alias("y"), F.col("items").alias("items_y")), "y")
    return full.select("x", "y", "items_x", "items_y").mapInArrow(task, "x long, y long")


def dealt(nodes: DataFrame, group: str) -> DataFrame:
    """Rows of groups that hold several labels, dealt out as pairs (i, j) of bounded blocks.

    A row goes to every pair with its block, so each two rows of a group meet in one task,
    whatever the group's size.  With a column ``bytes`` blocks are bounded by that as well.
    """
    held = F.sum("bytes") if "bytes" in nodes.columns else F.lit(0)
    mixed = (
        nodes.groupBy(group)
        .agg(F.count("*").alias("size"), held.alias("held"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
        .select(group, F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("held") / BLOCK_BYTES)).cast("int").alias("blocks"))
    )
    placed = nodes.join(mixed, group).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.col(group).alias("key"), F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rep", "label"
    )


def compared(rows: pa.Table, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of one (key, i, j), with different labels, that may reach the threshold."""
    key, i, j, mine, label, n = (rows.column(c).to_numpy() for c in ("key", "i", "j", "mine", "label", "n"))
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), dtype=np.int16).reshape(-1, REGISTERS)
    least = REGISTERS * (threshold - 1.5 * SLACK)  # fewer equal registers: not worth an estimate
    border = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    ends = np.append(border, len(key))
    later = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - np.arange(len(key)) - 1
    total, start = np.cumsum(later), 0
    while start < len(key):
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + PAIRS, side="right")))
        count = later[start:stop]
        a = np.repeat(np.arange(start, stop), count)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
        start = stop
        ok = (label[a] != label[b]) & ((i[a] == j[a]) | (mine[a] != mine[b]))
        ok &= np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b]) - 1
        a, b = a[ok], b[ok]
        ok = (sketch[a] == sketch[b]).sum(axis=1) >= least
        a, b = a[ok], b[ok]
        up, down = (sketch[a] > sketch[b]).sum(axis=1), (sketch[a] < sketch[b]).sum(axis=1)
        ok = likely_similarity(up, down, n[a].astype(float), n[b].astype(float)) >= threshold - SLACK
        yield a[ok], b[ok]


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of sorted rows, joined and cut so that no (key, i, j) is divided."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
        key, i, j = (rows.column(c).to_numpy() for c in ("key", "i", "j"))
        other = np.flatnonzero((key != key[-1]) | (i != i[-1]) | (j != j[-1]))
        open_from = int(other[-1]) + 1 if len(other) else 0
        held = rows.slice(open_from)
        if open_from:
            yield rows.slice(0, open_from)
    if held is not None:
        yield held


class Forest:
    """Union-find over the nodes a task meets."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def in_groups(placed: DataFrame) -> DataFrame:
    return placed.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def families(members: DataFrame, sets: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """(node, label): nodes joined by likely links across components within a bucket.

    A task reports a spanning forest of the likely links it finds, not the links.
    """
    labelled = members.join(labels, members["rep"] == labels["node"], "left").select("key", "rep", F.coalesce("label", "rep").alias("label"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for rows in whole_groups(batches):
            rep = rows.column("rep").to_numpy()
            for a, b in compared(rows, threshold):
                new = [(x, y) for x, y in zip(rep[a].tolist(), rep[b].tolist()) if forest.join(x, y)]
                if new:
                    x, y = zip(*new)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

    full = dealt(labelled, "key").join(sets.select("rep", "n", "sketch"), "rep")
    return components(in_groups(full).mapInArrow(task, "x long, y long"), "x", "y")


def family_links(groups: DataFrame, sets: DataFrame, labels: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) across components inside a family, each confirmed on full sets.

    Links that join what a task has already joined are left out.
    """
    threshold = percent / 100
    nodes = groups.select(F.col("node").alias("rep"), F.col("label").alias("family"))
    nodes = nodes.join(labels, nodes["rep"] == labels["node"], "left").select("family", "rep", F.coalesce("label", "rep").alias("label"))
    nodes = nodes.join(sets.select("rep", (8 * F.col("n")).alias("bytes")), "rep")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for rows in whole_groups(batches):
            rep, label = rows.column("rep").to_numpy(), rows.column("label").to_numpy()
            whole = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in rows.column("items")]
            for a, b in compared(rows, threshold):
                new = []
                for k, m in zip(a.tolist(), b.tolist()):
                    x, y = int(label[k]), int(label[m])
                    if forest.root(x) != forest.root(y) and similar(whole[k], whole[m], percent):
                        forest.join(x, y)
                        new.append((int(rep[k]), int(rep[m])))
                if new:
                    x, y = zip(*new)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

    full = dealt(nodes, "family").join(sets.select("rep", "n", "sketch"), "rep").join(items, "rep")
    return in_groups(full).mapInArrow(task, "x long, y long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: the id, n_shingles, component_id (smallest id reachable by links) and kept.

    Links are pairs with 100 * intersection >= percent * union of their shingle sets.
    """
    threshold = percent / 100
    rows = stored(sketched(docs, doc_id, text, size), "sketches", TEXT_ROWS)
    sets = stored(
        rows.where("n > 0 and id is not null").groupBy("sum_a", "sum_b", "n").agg(F.min("id").alias("rep"), F.first("sketch").alias("sketch")),
        "sets",
    )
    buckets = bands(sets)
    centres = buckets.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("last")).where("centre < last").select("key", "centre")
    members = stored(buckets.join(centres, "key"), "members")
    items = stored(full_sets(docs, members.select("rep").distinct(), doc_id, text, size), "items", TEXT_ROWS)

    stars = members.where("rep > centre").select(F.col("centre").alias("x"), F.col("rep").alias("y")).distinct()
    pairs = stored(estimated(stars, sets, threshold), "pairs")
    links = stored(confirmed(pairs, items, percent), "links", SET_ROWS)
    first = components(links, "x", "y")

    groups = families(members, sets, first, threshold)
    more = stored(family_links(groups, sets, first, items, percent), "links", SET_ROWS)
    labels = components(links.union(more), "x", "y")
    dropped(members, items, pairs, links, first, groups, more)

    known = sets.select("sum_a", "sum_b", "n", "rep").join(labels, sets["rep"] == labels["node"], "left")
    known = known.select("sum_a", "sum_b", "n", F.coalesce("label", "rep").alias("label"))
    joined = rows.select("id", "n", "sum_a", "sum_b").join(known, ["sum_a", "sum_b", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("label", "id"))
    return joined.select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near-duplicates, with the columns it came with.

    Documents without words and rows without an id all stay.  Of rows that repeat an id and
    its text one stays.
    """
    gone = near_duplicates(docs, doc_id, text, size, percent).where("not kept").select(F.col(doc_id).alias("__gone")).distinct()
    left = docs.join(gone, docs[doc_id].cast("long") == gone["__gone"], "left_anti")
    order = Window.partitionBy(doc_id, F.xxhash64(text)).orderBy(F.lit(0))
    free = F.col(doc_id).isNull() | (F.length(F.trim(F.coalesce(F.translate(text, "\t\n\x0b\x0c\r", "     "), F.lit("")))) == 0)
    return left.withColumn("__copy", F.row_number().over(order)).where(free | (F.col("__copy") == 1)).drop("__copy")
