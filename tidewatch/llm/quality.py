"""Quality rules: repetition and length rules, then a hashed n-gram likelihood ratio.

``fit`` counts hashed byte trigrams over every document (the raw multinomial) and over the
all trusted documents (the target multinomial).  A document's score is the mean of
log(target / raw) over its trigrams; documents below one threshold go, which is placed on the
scores of all labelled documents.  The ratios are whole numbers (units of 2^-20 nats), so sums
do not depend on how rows are split.

Null, empty and blank texts have no words, fail the length rule and are not kept.  Rows are
judged one by one: repeated ids and repeated rows each get their own verdict.  Other columns are
carried along by ``keep_good``; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import dropped, find_words, mix64, pieces, segment_hashes, stored, sums_between, text_bytes

BITS = 16
UNIT = 1 << 20
#: a trusted document lost weighs as much as this many junk documents kept
CARE = 100.0
MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20
SYMBOL_BYTES = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))


@dataclass
class Ratio:
    """log(target / raw) per bucket in units of 2^-20, and the lowest score that is kept."""

    table: np.ndarray
    threshold: float


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram that starts at each byte, and whether it lies inside its row."""
    n = len(data)
    valid = np.zeros(n, dtype=bool)
    bucket = np.zeros(n, dtype=np.uint32)
    if n >= 3:
        d = data.astype(np.uint32)
        v = d[:-2] | (d[1:-1] << np.uint32(8)) | (d[2:] << np.uint32(16))
        bucket[:-2] = (v * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        valid[:-2] = True
        for back in (1, 2):
            at = offsets[1:] - back
            valid[at[(at >= 0) & (at < n)]] = False
    return bucket, valid


def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams of ``__text`` per bucket, as far as this task sees them."""
    n = np.zeros(1 << BITS, dtype=np.int64)
    for piece in pieces(batches, "__text"):
        data, offsets = text_bytes(piece.column(piece.schema.get_field_index("__text")))
        bucket, valid = trigrams(data, offsets)
        n += np.bincount(bucket[valid], minlength=1 << BITS)
    some = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["bucket", "n"])


def multinomial(rows: DataFrame) -> np.ndarray:
    """Trigrams per bucket over all rows' ``__text``."""
    counted = rows.select("__text").mapInArrow(count_trigrams, "bucket long, n long")
    totals = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << BITS)
    out[totals["bucket"]] = totals["n"]
    return out


def mean_ratio(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    bucket, valid = trigrams(data, offsets)
    summed = sums_between(np.where(valid, table[bucket], 0), offsets)
    return summed / (np.maximum(np.diff(offsets) - 2, 1) * float(UNIT))


def repeated_words(hashes: np.ndarray) -> int:
    """Words of one text that lie in a window of five words found twice or more in it."""
    n = len(hashes) - WINDOW + 1
    if n < 2:
        return 0
    window = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        window = mix64(window + hashes[k : k + n])
    _, inverse, count = np.unique(window, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[inverse] > 1)
    if not len(twice):
        return 0
    edge = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def measures(data: np.ndarray, offsets: np.ndarray, texts: list[str]) -> dict[str, np.ndarray]:
    starts, lengths, bounds = find_words(data, offsets)
    hashes = segment_hashes(data, starts, lengths)
    heads = (data & 0xC0) != 0x80  # the first byte of each code point
    inside = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + lengths, -1)
    in_word = np.cumsum(inside[:-1]) > 0
    n_words = np.diff(bounds)
    repeats = np.array([repeated_words(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], dtype=np.int64)
    return {
        "n_words": n_words.astype(np.int64),
        "word_chars": sums_between(heads & in_word, offsets),
        "n_symbols": sums_between(SYMBOL_BYTES[data], offsets),
        "n_dup_lines": np.array([repeated_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": repeats,
        "base_failed": (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words),
    }


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> Ratio:
    """Count both multinomials over all documents and all trusted ones, then place the threshold.

    The threshold is the score at which lost trusted documents (times CARE) and kept junk of
    all labelled documents are fewest; documents that the rules reject take no part.  Without
    labelled documents of both kinds everything that passes the rules is kept.  Labels grow with
    the documents, so they are joined by a shuffle; the joined texts are kept for the two
    passes over them.
    """
    given = labels.where(F.col(quality).isNotNull() & F.col(doc_id).isNotNull())
    given = given.groupBy(F.col(doc_id).alias("__id")).agg(F.max(F.col(quality).cast("int")).alias("__quality"))
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    # hash tables of labels; the texts are not sorted
    known = stored(rows.join(given.hint("shuffle_hash"), "__id").select("__text", "__quality"), "labelled")
    target = multinomial(known.where("__quality = 1"))
    if not target.sum():
        dropped(known)
        return Ratio(np.zeros(1 << BITS, dtype=np.int64), -np.inf)
    raw = multinomial(rows)
    q = (raw + 1) / (raw.sum() + len(raw))
    # the target is smoothed by the raw corpus: rare buckets say little
    p = (target + 100.0 * q * 10) / (target.sum() + 1000.0)
    table = np.round(np.log(p / q) * UNIT).astype(np.int64)

    threshold = threshold_of(known.mapInArrow(score_task(table), "score double, quality int"))
    dropped(known)
    return Ratio(table, threshold)


def score_task(table: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "__text"):
            column = piece.column(piece.schema.get_field_index("__text"))
            data, offsets = text_bytes(column)
            some = ~measures(data, offsets, [t or "" for t in column.to_pylist()])["base_failed"]
            quality = piece.column(piece.schema.get_field_index("__quality")).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(mean_ratio(table, data, offsets)[some]), pa.array(quality[some].astype(np.int32))], ["score", "quality"]
            )

    return task


def cheapest(scores: np.ndarray, good: np.ndarray, junk: np.ndarray, before: tuple[int, int], totals: tuple[int, int], previous: float | None) -> tuple[float, float]:
    """Weighted mistakes and place of the best threshold just below one of the rising ``scores``.

    ``good`` and ``junk`` are the documents at each score, ``before`` those at lower scores, of
    which ``previous`` is the last; thresholds lie halfway between two scores.
    """
    lost = (before[0] + np.cumsum(good) - good) / totals[0]
    kept = before[1] + np.cumsum(junk) - junk
    cost = CARE * lost + (totals[1] - kept) / totals[1]
    at = int(np.argmin(cost))
    below = scores[at - 1] if at else previous
    return float(cost[at]), float(scores[0] - 1 if below is None else (below + scores[at]) / 2)


def place_threshold(scores: np.ndarray, trusted: np.ndarray) -> float:
    """Halfway between two neighbouring scores, where the weighted mistakes are fewest."""
    if trusted.all() or not trusted.any():
        return -np.inf
    scores, place = np.unique(scores, return_inverse=True)
    good, junk = (np.bincount(place[kind], minlength=len(scores)) for kind in (trusted, ~trusted))
    # the last is the place above all scores, where all trusted documents are lost
    return min(cheapest(scores, good, junk, (0, 0), (good.sum(), junk.sum()), None), (CARE, float(scores[-1] + 1)))[1]


def threshold_of(scored: DataFrame) -> float:
    """:func:`place_threshold` of rows (score, quality), in ranges of scores; the driver sees a row per range."""
    rows = stored(scored, "scores")
    good = F.count(F.when(F.col("quality") == 1, 1))
    counts = rows.groupBy("score").agg(good.alias("good"), (F.count("*") - good).alias("junk"))
    ranges = stored(counts.repartitionByRange("score").withColumn("part", F.spark_partition_id()), "ranges")
    sums = ranges.groupBy("part").agg(F.sum("good").alias("good"), F.sum("junk").alias("junk"), F.max("score").alias("last")).orderBy("last").collect()
    totals = (sum(r["good"] for r in sums), sum(r["junk"] for r in sums))
    if not all(totals):
        dropped(rows, ranges)
        return -np.inf
    before, held, previous = {}, (0, 0), None
    for r in sums:
        before[r["part"]] = (held, previous)
        held, previous = (held[0] + r["good"], held[1] + r["junk"]), r["last"]

    def task(table: pa.Table) -> pa.Table:
        table = table.sort_by("score")
        earlier, last = before[table.column("part")[0].as_py()]
        cost, edge = cheapest(*(table.column(c).to_numpy() for c in ("score", "good", "junk")), earlier, totals, last)
        return pa.table({"cost": [cost], "edge": [edge]})

    found = ranges.groupBy("part").applyInArrow(task, "cost double, edge double").collect()
    dropped(rows, ranges)
    return min([*((r["cost"], r["edge"]) for r in found), (CARE, previous + 1)])[1]


def judged(batch: pa.RecordBatch, text: str, ratio: Ratio) -> dict[str, np.ndarray]:
    """All measures, the score and the verdict of each row."""
    column = batch.column(batch.schema.get_field_index(text))
    data, offsets = text_bytes(column)
    out = measures(data, offsets, [t or "" for t in column.to_pylist()])
    out["score"] = mean_ratio(ratio.table, data, offsets)
    out["kept"] = ~out["base_failed"] & (out["score"] >= ratio.threshold)
    return out


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def quality_report(docs: DataFrame, ratio: Ratio, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, the measures, the score and whether it is kept."""
    model = docs.sparkSession.sparkContext.broadcast(ratio)
    kind = docs.schema[doc_id].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            out = judged(piece, text, model.value)
            yield pa.RecordBatch.from_arrays([piece.column(0), *[pa.array(v) for v in out.values()]], [doc_id, *out])

    return docs.select(doc_id, text).mapInArrow(task, f"{doc_id} {kind}, {MEASURES}")


def keep_good(docs: DataFrame, ratio: Ratio, text: str = "text") -> DataFrame:
    """The documents that are kept, with the columns they came with."""
    model = docs.sparkSession.sparkContext.broadcast(ratio)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            yield piece.filter(pa.array(judged(piece, text, model.value)["kept"]))

    return docs.mapInArrow(task, docs.schema)
