"""Periodic runs against a brute-force search over all starts and periods."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

from conftest import SMALL
from tidewatch.llm import queries, runs


def brute(words, min_words=24, min_times=3):
    """All (start, length, period): every period's maximal stretches, those with a smaller period left out."""
    n, found = len(words), {}
    for q in range(1, n // min_times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            # a stretch of a multiple of its smallest period has been found with that one
            if length >= max(min_words, min_times * q) and not any(s <= i and i + length <= s + m for s, m, _ in found.values()):
                found[i, q] = (i, length, q)
            i = j
    return sorted(found.values(), key=lambda r: (r[0], r[2]))


def numbered(rows):
    words = np.array([w for row in rows for w in row], dtype=np.int64)
    return words, np.cumsum([0, *map(len, rows)])


def in_rows(found, bounds):
    rows = [[] for _ in range(len(bounds) - 1)]
    for start, length, period in found:
        k = int(np.searchsorted(bounds, start, side="right")) - 1
        rows[k].append((int(start - bounds[k]), length, period))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in rows]


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_short_runs_of_few_letters(letters):
    rng = np.random.default_rng(letters)
    rows = [rng.integers(0, letters, rng.integers(0, 40)).tolist() for _ in range(150)]
    words, bounds = numbered(rows)
    assert in_rows(runs.find_runs(words, bounds, min_words=2, min_times=2), bounds) == [brute(r, 2, 2) for r in rows]
    assert in_rows(runs.find_runs(words, bounds, min_words=6, min_times=3), bounds) == [brute(r, 6, 3) for r in rows]


def test_planted_runs():
    rng, rows = np.random.default_rng(5), []
    for _ in range(60):
        unit = rng.integers(0, 4, rng.integers(1, 30)).tolist()
        row = rng.integers(0, 4, rng.integers(0, 20)).tolist() + unit * int(rng.integers(2, 9)) + unit[: rng.integers(0, len(unit) + 1)]
        rows.append(row + rng.integers(0, 4, rng.integers(0, 20)).tolist())
    rows += [rows[0] * 2, [7] * 500, [], [1, 2] * 12, [1, 2] * 12 + [1]]
    words, bounds = numbered(rows)
    got = in_rows(runs.find_runs(words, bounds), bounds)
    assert got == [brute(r) for r in rows]
    assert sum(map(len, got)) > 40 and got[-2:] == [[(0, 24, 2)], [(0, 25, 2)]]


def test_best_run_takes_the_exact_exponent():
    assert runs.best_run([]) is None
    assert runs.best_run([(9, 30, 10), (4, 24, 8), (4, 27, 9), (1, 31, 11)]) == (4, 24, 8)
    assert runs.best_run([(0, 24, 8), (3, 25, 8)]) == (3, 25, 8)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {k for s, m, q in found for k in range(s + q, s + m)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{m},{q}\n" for s, m, q in found), " ".join(w for k, w in enumerate(words) if k not in gone))]
    return (len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2], *sha)


def test_query_against_brute_force(spark, scratch):
    line = "same old line again and "
    odd = [(None, line * 9), (-1, None), (-2, ""), (-3, " \n\t"), (-4, line * 9), (-4, line * 9), (-5, "x " * 24), (-6, "x " * 23), (-7, "a b c " * 300 + "ü b c " * 20 + "z")]
    odd += [(10**6 + k, f"one two {k} three four five six seven " * 8) for k in range(60)]
    table = spark.read.parquet(f"{SMALL}/documents.parquet").where("n_chars < 6000").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()] + odd
    spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, start string, n_runs int").write.parquet(f"{scratch}/documents.parquet")
    got = queries.op11_periodic_runs(spark, scratch)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(((i, *expected(i, t)) for i, t in rows), key=repr)
    assert got.where("n_runs > 0").count() > 40


def test_empty_table_and_a_text_longer_than_a_piece(spark):
    schema = "doc_id long, text string, runs string, collapsed int"
    assert runs.periodic_runs(spark.createDataFrame([], schema)).collect() == []
    words = [f"w{k}" for k in range(150_000)]
    words += [f"v{k}" for k in range(70_000)] * 3
    row = runs.periodic_runs(spark.createDataFrame([(1, " ".join(words), "x", 2)], schema)).first()
    assert [tuple(r) for r in row["runs"]] == [(150_000, 210_000, 70_000)] and row["n_words"] == 360_000
    assert row["collapsed"] == " ".join(words[:220_000])
