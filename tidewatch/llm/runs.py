"""Periodic runs of words by descending-LCP union of suffix classes.

A run is a stretch of consecutive words with smallest period q that no neighbouring word
extends.  The suffixes of a text are sorted by prefix doubling, and suffixes that share a
prefix are united into classes in the order of falling common prefix (a maximum spanning
tree of the suffixes, by Kruskal's rule).  A class keeps its positions in order; when two
classes meet, positions i < j that become neighbours have a longest common prefix equal to
the present level, so if j - i lies within the level, a run of period j - i starts at i or
before.  The first position s of a run and s + q become neighbours at level length - q: a
position between them in the class would give the run a period smaller than q.  So every run
whose length is at least twice its period is seeded by its own first position, once, and a
seed needs no extension: it counts if the word before i breaks the period.

All rows of a bounded piece are sorted together, in numpy, with classes that never span two
rows.  Words are numbered exactly (dictionary encoding), nothing is hashed.  Doubling goes on
only for suffixes that still share their prefix, and only classes with a common prefix of at
least the shortest possible one are united, so a text without long repeats costs a few sorts.
Memory follows the longest text: about 4 bytes per word and doubling.

A null, empty or blank text has no words and no runs; a null id changes nothing.  Rows that
repeat are worked on each for itself.  An empty table gives an empty table.  A column of an
output's name is replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import WORD_BYTES, find_words, pieces, text_bytes

MIN_WORDS = 24
MIN_TIMES = 3
#: classes up to this size take single insertions, larger ones are merged as sorted lists
SMALL_MERGE = 8

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def number_words(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Equal words get equal numbers; ``lengths`` are those of the words in ``data``, in order."""
    if not len(lengths):
        return np.zeros(0, dtype=np.int64)
    letters = data[WORD_BYTES[data]]
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def group_starts(keys: np.ndarray) -> np.ndarray:
    """For sorted keys, the index at which each element's group of equal keys starts."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))


def suffix_order(keys: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffixes sorted by prefix doubling: the order, neighbours to unite, ranks per doubling.

    ``keys`` tell symbols and rows apart; ``ends[i]`` is the end of the row that i lies in.
    A neighbour is a slot s such that order[s] and order[s + 1] share a prefix of at least
    ``floor(least)`` rounded down to a power of two.  ``ranks[k]`` ranks all suffixes by their
    first 2^k symbols.  Suffixes whose rank is unique are not sorted again.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    starts = group_starts(keys[order])
    rank = np.empty(n, dtype=np.int32)
    rank[order] = starts
    ranks, h, near = [rank.copy()], 1, None
    while True:
        same = np.zeros(n, dtype=bool)
        same[:-1] = rank[order[1:]] == rank[order[:-1]]
        if near is None and 2 * h > least:
            near = np.flatnonzero(same)
        active = same.copy()
        active[1:] |= same[:-1]
        slots = np.flatnonzero(active)
        if not len(slots):
            break
        at = order[slots]
        after = at + h
        inside = after < ends[at]
        second = np.where(inside, rank[np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
        key = rank[at].astype(np.int64) * (n + 1) + second
        by = np.argsort(key, kind="stable")
        order[slots] = at[by]
        rank = rank.copy()
        rank[at[by]] = slots[group_starts(key[by])]
        ranks.append(rank)
        h *= 2
    return order, near if near is not None else np.zeros(0, dtype=np.int64), ranks


def common_prefixes(a: np.ndarray, b: np.ndarray, ends: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Longest common prefixes of suffixes a and b of the same row, by descent over the ranks."""
    length = np.zeros(len(a), dtype=np.int64)
    last = ends[a] if len(a) else ends[:0]
    for k in range(len(ranks) - 1, -1, -1):
        x, y = a + length, b + length
        ok = (x < last) & (y < last)
        ok[ok] = ranks[k][x[ok]] == ranks[k][y[ok]]
        length[ok] += 1 << k
    return length


def unite(a: list[int], b: list[int], level: list[int], seed) -> None:
    """Unite suffix classes edge by edge; ``seed(i, j, level)`` hears of every new neighbour pair.

    Edges come by falling level.  The smaller class is put into the larger one, so a position
    moves at most log2(n) times.
    """
    up: dict[int, int] = {}
    held: dict[int, list[int]] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    for x, y, height in zip(a, b, level):
        x, y = root(x), root(y)
        large, small = held.pop(x, None) or [x], held.pop(y, None) or [y]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        up[y] = x
        if small[0] > large[-1]:
            seed(large[-1], small[0], height)
            large.extend(small)
        else:
            n, spot = len(large), 0
            for k, p in enumerate(small):
                spot = bisect_left(large, p, spot, n)
                if spot and (not k or small[k - 1] < large[spot - 1]):
                    seed(large[spot - 1], p, height)
                if spot < n and (k + 1 == len(small) or small[k + 1] > large[spot]):
                    seed(p, large[spot], height)
            if len(small) <= SMALL_MERGE:
                for p in small:
                    large.insert(bisect_left(large, p), p)
            else:
                large += small
                large.sort()  # two ordered stretches: linear
        held[x] = large


def find_runs(words: np.ndarray, bounds: np.ndarray, min_words: int = MIN_WORDS, min_times: int = MIN_TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, starts counted over all rows, in no fixed order.

    ``words`` are the word numbers of all rows, ``bounds`` the n + 1 borders of the rows.
    A run has at least ``min_words`` words and ``min_times`` periods, two or more.
    """
    if min_times < 2:
        raise ValueError("a run needs at least two periods")
    # length - period is at least this for every run that counts
    least = max(1, min(max(min_words - q, (min_times - 1) * q) for q in range(1, min_words + 1)))
    if len(words) <= least:
        return []
    sizes = np.diff(bounds)
    row = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.repeat(bounds[1:], sizes)
    keys = row * (int(words.max()) + 1) + words
    order, near, ranks = suffix_order(keys, ends, least)
    if not len(near):
        return []
    a, b = order[near], order[near + 1]
    level = common_prefixes(a, b, ends, ranks)
    deep = level >= least
    a, b, level = a[deep], b[deep], level[deep]
    falling = np.argsort(-level, kind="stable")
    found: list[tuple[int, int, int]] = []

    def seed(i: int, j: int, height: int) -> None:
        period = j - i
        if height >= (min_times - 1) * period and height + period >= min_words and (not i or keys[i - 1] != keys[j - 1]):
            found.append((i, height + period, period))

    unite(a[falling].tolist(), b[falling].tolist(), level[falling].tolist(), seed)
    return found


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    best = None
    for run in sorted(runs):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, min_times: int = MIN_TIMES) -> DataFrame:
    """The rows with their runs and their text without the repeats.

    Further columns: n_words, runs (by start, then period; never null), best (the run of the
    greatest exponent, null without runs), collapsed (the words kept, joined by one space;
    a word goes if a run holds it after that run's first period).
    """
    docs = docs.drop("n_words", "runs", "best", "collapsed")
    added = {"n_words": "bigint", "runs": f"array<{RUN}>", "best": RUN, "collapsed": "string"}
    schema = docs.withColumns({name: F.lit(None).cast(kind) for name, kind in added.items()}).schema
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            data, offsets = text_bytes(piece.column(piece.schema.get_field_index(text)))
            starts, lengths, bounds = find_words(data, offsets)
            found = find_runs(number_words(data, lengths), bounds, min_words, min_times)
            rows: list[list[tuple[int, int, int]]] = [[] for _ in range(piece.num_rows)]
            kept = np.ones(len(starts), dtype=bool)
            for start, length, period in sorted(found, key=lambda run: (run[0], run[2])):
                k = int(np.searchsorted(bounds, start, side="right")) - 1
                rows[k].append((int(start - bounds[k]), length, period))
                kept[start + period : start + length] = False
            yield pa.RecordBatch.from_arrays(
                [
                    *piece.columns,
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in rows], pa.list_(run_type)),
                    pa.array([dict(zip(("start", "length", "period"), r)) if (r := best_run(runs)) else None for runs in rows], run_type),
                    joined_words(data, starts, lengths, bounds, kept),
                ],
                [*piece.schema.names, *added],
            )

    return docs.mapInArrow(task, schema)


def joined_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, bounds: np.ndarray, kept: np.ndarray) -> pa.Array:
    """Per row, the kept words with one space between."""
    counts = np.concatenate([[0], np.cumsum(kept)])[bounds]
    starts, lengths = starts[kept], lengths[kept]
    sizes = lengths + 1  # each word and a space; a row's last space is cut off
    total = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=total[1:])
    out = np.full(int(total[-1]), 0x20, dtype=np.uint8)
    if len(starts):
        shift = np.repeat(starts - total[:-1], lengths)
        place = np.arange(len(shift)) + np.repeat(np.arange(len(starts)), lengths)
        out[place] = data[place + shift]
    text = out.tobytes()
    cuts = total[counts].tolist()
    return pa.array([text[x : y - 1].decode() if y > x else "" for x, y in zip(cuts[:-1], cuts[1:])], pa.string())


def exponent_milli(run: str = "best") -> F.Column:
    """floor(1000 * length / period) of a run column, in whole numbers."""
    return F.expr(f"1000 * {run}.length div {run}.period")


def with_repeated_tail(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts as the run query takes them: one document in ten gets a periodic tail.

    Let h = crc32 of the decimal id and g = h div 10.  If h % 10 = 0 and the text has n > 0
    words, each word i >= a becomes word a + (i - a) % p, a = g % n, p = 1 + (n - a) div
    (3 + g % 8), and words are joined by one space.  Other texts and null ids stay.
    """
    docs = docs.withColumn("__h", F.crc32(F.col(doc_id).cast("string").cast("binary")))
    words = F.filter(F.split(F.col(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    docs = docs.withColumn("__words", F.when(F.col("__h") % 10 == 0, words)).withColumn("__n", F.size("__words").cast("long"))
    docs = docs.withColumn("__g", F.expr("__h div 10")).withColumn("__a", F.expr("__g % greatest(__n, 1)"))
    docs = docs.withColumn("__p", F.expr("1 + (__n - __a) div (3 + __g % 8)"))
    source = "cast(if(i < __a, i, __a + (i - __a) % __p) as int) + 1"
    tailed = F.expr(f"array_join(transform(sequence(0L, __n - 1), i -> element_at(__words, {source})), ' ')")
    return docs.withColumn(text, F.when(F.col("__n") > 0, tailed).otherwise(F.col(text))).drop("__h", "__g", "__words", "__n", "__a", "__p")
