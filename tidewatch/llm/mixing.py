"""Mix sources to target weights by pivotal dependent rounding.

Every document of a source gets the same copy number target / size of the source.  Whole
copies are certain; the fractions are rounded by a pivotal walk: two documents with open
fractions pass words between them, at random but fair, until one of them is whole.  The words
of the two never change in sum, so a walk leaves one open document and an error below its
size.  Walks run per source and chunk in parallel; the documents they leave open meet again
in a reduction tree until one per source is left, which goes to the nearer side.

All draws are hashes of ids: reruns agree.  Rows that agree in id, source and size are one
unit and get the same copies.  Null texts have size 0 and are taken 0 words; a null source is a
source of its own, and so is the empty one.  Other columns are carried along by ``mixed``; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import find_words, mix64, pieces, stored, text_bytes

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
#: documents of one walk, and open documents that meet in a node of the tree
CHUNK = 2_000
SEED = 17


def with_sizes(docs: DataFrame, text: str = "text", size: str = "size") -> DataFrame:
    """The rows with a further column: the number of words of the whole text."""
    docs = docs.drop(size)
    schema = docs.withColumn(size, F.lit(0).cast("long")).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            _, _, bounds = find_words(*text_bytes(piece.column(piece.schema.get_field_index(text))))
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(np.diff(bounds).astype(np.int64))], [*piece.schema.names, size])

    return docs.mapInArrow(task, schema)


def targets(units: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, units, target), one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` times
    all words.  A target stops at ``most`` times its source; the excess is shared again by
    weight until none is above.  The order is numbered by range partitions and their counts,
    so sources may be many.
    """
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("units"))
    ordered = stored(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    counts = ordered.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # a row per partition
    before = np.cumsum([0, *[r["n"] for r in counts]])
    starts = ordered.sparkSession.createDataFrame([(r["part"], int(b)) for r, b in zip(counts, before)], "part int, start long")
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1 + F.col("start")
    turn = F.array(*map(F.lit, weights))[(place % len(weights)).cast("int")]
    weighed = stored(ordered.join(F.broadcast(starts), "part").withColumn("weight", turn).select("source", "source_size", "units", "weight"), "weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words per unit of weight; it only rises, and each turn caps a source more
    while True:
        capped = F.col("weight") * F.lit(level) >= F.col("source_size") * F.lit(most)
        fixed, open_weight, at = weighed.agg(
            F.sum(F.when(capped, F.col("source_size") * F.lit(most)).otherwise(0.0)),
            F.sum(F.when(~capped, F.col("weight")).otherwise(0.0)),
            F.count(F.when(capped, 1)),
        ).first()
        if not open_weight:
            break
        higher = (share * total - fixed) / open_weight
        if higher <= level:
            break
        level = higher
    goal = F.least(F.col("weight") * F.lit(level), F.col("source_size") * F.lit(most))
    return weighed.select("source", "source_size", "units", goal.cast("double").alias("target"))


def draws(ids: np.ndarray, turn: int) -> np.ndarray:
    """A number in [0, 1) for each id."""
    return (mix64(ids.view(np.uint64) + mix64(np.array([SEED + turn], dtype=np.uint64))) >> np.uint64(11)) / 2.0**53


def walk(words: np.ndarray, share: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Round fractions to 0 or 1, but for one: pass words between the open one and the next."""
    share = share.copy()
    held = -1
    for k in range(len(words)):
        if not 0 < share[k] < 1:
            continue
        if held < 0:
            held = k
            continue
        a, b = words[held], words[k]
        up = min((1 - share[held]) * a, share[k] * b)  # words that ``held`` may take from k
        down = min(share[held] * a, (1 - share[k]) * b)
        if draw[k] * (up + down) < down:
            full = (1 - share[held]) * a <= share[k] * b
            moved = ((share[held] * a + share[k] * b) - a) / b if full else share[held] + share[k] * b / a
            share[held], share[k] = (1.0, moved) if full else (moved, 0.0)
        else:
            none = share[held] * a <= (1 - share[k]) * b
            moved = share[k] + share[held] * a / b if none else share[held] - (1 - share[k]) * b / a
            share[held], share[k] = (0.0, moved) if none else (moved, 1.0)
        for n in (held, k):
            if min(share[n], 1 - share[n]) < 1e-9:
                share[n] = round(share[n])
        if not 0 < share[held] < 1:
            held = k if 0 < share[k] < 1 else -1
    return share


def walked(rows: DataFrame, turn: int, last: bool) -> DataFrame:
    """One walk per (source, chunk), largest documents first; in the last turn nothing stays open."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        size, ids = table.column("words").to_numpy(), table.column("unit").to_numpy()
        order = np.lexsort((ids, -size))
        draw = draws(ids, turn)
        share = np.empty(len(size))
        share[order] = walk(size[order].astype(float), table.column("part_share").to_numpy()[order], draw[order])
        if last:
            share = np.where((share > 0) & (share < 1), share >= 0.5, share).astype(float)
        table = table.set_column(table.schema.get_field_index("part_share"), "part_share", pa.array(share))
        yield from table.combine_chunks().to_batches()

    return rows.groupBy("source", "chunk").applyInArrow(task, rows.schema)


def copies(units: DataFrame) -> DataFrame:
    """(doc_id, source, size, rows, source_size, target, copies): the copies each unit's rows get."""
    goal = targets(units)
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = units.join(F.broadcast(goal) if goal.count() <= 10_000 else goal, units["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    unit = F.xxhash64("doc_id", "source", "size", F.lit(SEED))
    chunk = F.pmod(F.col("unit"), F.greatest(F.ceil(F.col("units") / CHUNK), F.lit(1))).cast("long")
    rows = (
        joined.withColumns({"wanted": wanted, "unit": unit, "words": F.col("size") * F.col("rows")})
        .withColumns({"whole": F.floor(F.col("wanted") + 1e-12), "chunk": chunk})
        .withColumn("part_share", F.when(F.col("size") > 0, F.greatest(F.col("wanted") - F.col("whole"), F.lit(0.0))).otherwise(0.0))
        .withColumn("part_share", F.when(F.col("part_share") < 1e-9, 0.0).otherwise(F.col("part_share")))
        .select("doc_id", "source", "size", "rows", "source_size", "target", "units", "unit", "words", "whole", "chunk", "part_share")
    )
    is_open = "part_share > 0 and part_share < 1"
    done, turn, at = None, 0, rows
    largest = goal.agg(F.max("units")).first()[0] or 1
    groups = -(-largest // CHUNK)
    while True:
        last = groups <= 1
        at = stored(walked(at, turn, last), "walk")
        closed = at if last else at.where(f"not ({is_open})")
        done = closed if done is None else done.unionByName(closed)
        if last:
            break
        # each chunk leaves one open document at most; a node of the tree takes CHUNK of them
        groups, turn = -(-groups // CHUNK), turn + 1
        at = at.where(is_open).withColumn("chunk", F.floor(F.col("chunk") / CHUNK).cast("long"))
    return done.select("doc_id", "source", "size", "rows", "source_size", "target", (F.col("whole") + F.round("part_share")).cast("long").alias("copies"))


def units_of(sized: DataFrame, doc_id: str, source: str, size: str) -> DataFrame:
    return sized.groupBy(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(size).alias("size")).agg(F.count("*").alias("rows"))


def mixture(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Per document: id, size, source_size, target of its source, taken (words, repeats counted)."""
    sized = with_sizes(docs.select(doc_id, source, text), text, "__size")
    units = stored(units_of(sized, doc_id, source, "__size"), "units")
    taken = copies(units).withColumn("__each", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return taken.select(F.col("doc_id").alias(doc_id), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The documents as often as the mix takes them, with the columns they came with."""
    sized = with_sizes(docs, text, "__size")
    units = stored(units_of(sized.select(doc_id, source, "__size"), doc_id, source, "__size"), "units")
    some = copies(units).where("copies > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__its"), F.col("copies").alias("__copies")
    )
    match = sized[doc_id].eqNullSafe(some["__id"]) & sized[source].eqNullSafe(some["__source"]) & (sized["__size"] == some["__its"])
    repeated = sized.join(some, match).withColumn("__each", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
