"""Language-model scores: base terms against a plain count, training that grows with the input."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SMALL
from tidewatch.llm import lm, queries
from tidewatch.llm.common import segment_hashes
from tidewatch.llm.gru import Gru, Streams


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_query_against_a_plain_count(spark, scratch):
    table = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    table += [(10**6, None), (10**6 + 1, ""), (10**6 + 2, " \t\n"), (10**6 + 3, "unseenword Ünseen É é"), (5, table[5][1])]
    spark.createDataFrame([(*r, 0, 1.0) for r in table], "doc_id long, text string, n_tokens int, score double").write.parquet(f"{scratch}/documents.parquet")
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in table}
    counts = Counter(t for i, text in table if not held[i] for t in [*words(text), None])
    total, distinct = sum(counts.values()), len(counts)
    got = queries.op4_lm_score(spark, scratch).collect()
    assert len(got) == len(table)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    for i, text in table:
        tokens = [*words(text), None]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        for r in by_id[i]:
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(tokens), sum(counts[t] > 0 for t in tokens), total)
            assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9) and r["score"] < 0
    kept = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in kept) > sum(r["base_score"] for r in kept) * 0.95


def test_training_text_grows_with_the_input(spark, monkeypatch):
    """The network sees whole documents, a share of them, dealt to learners; nothing is capped."""
    monkeypatch.setattr(lm, "LEAST_TOKENS", 1000)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    twice = docs.union(docs.selectExpr("doc_id + 1000000 AS doc_id", "text"))
    seen = []
    for table in (docs, twice):
        vocabulary = lm.vocabulary(lm.word_counts(table, "text"), table.count())
        parts = lm.training_ids(table, "doc_id", "text", vocabulary, lm.SHARE, 7).collect()
        ends = sum(r["ids"].count(len(vocabulary.head_class) + lm.TAIL_CLASSES) for r in parts)
        assert ends == len(parts) and {r["learner"] for r in parts} <= set(range(7))
        seen.append(sum(len(r["ids"]) for r in parts))
        assert max(len(r["ids"]) for r in lm.training_ids(table, "doc_id", "text", vocabulary, 1.0, 7).collect()) == max(len(words(r["text"])) + 1 for r in table.collect())
        assert 0.04 * vocabulary.total < seen[-1] < 0.3 * vocabulary.total
    assert seen[1] > 1.3 * seen[0]


def test_learners_are_averaged_in_a_tree(spark, monkeypatch):
    """Many learners, two at a node: the result is the mean by tokens, and better than no training."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(60)
    vocabulary = lm.vocabulary(lm.word_counts(docs, "text"), 60)
    sample = lm.training_ids(docs, "doc_id", "text", vocabulary, 1.0, 9)
    start = lm.Model(vocabulary.head_class)
    monkeypatch.setattr(lm, "ROUNDS", 1)
    wide = lm.trained(start, sample, 9, 2).weights()
    monkeypatch.setattr(lm, "FAN_IN", 2)
    deep = lm.trained(start, sample, 9, 2)
    assert np.abs(wide - deep.weights()).max() < 1e-4 and np.abs(wide - start.weights()).max() > 0.01
    rows = [np.array(r["ids"][:-1]) for r in sample.collect()]
    ids, bounds = np.concatenate(rows), np.cumsum([0, *map(len, rows)])
    assert deep.totals(ids, bounds).sum() > start.totals(ids, bounds).sum()


def test_the_network_learns_from_all_training_text(spark, monkeypatch):
    """However much text there is: every training document, once, whole."""
    monkeypatch.setattr(lm, "LEAST_TOKENS", 1000)
    monkeypatch.setattr(lm, "LEARNER_TOKENS", 30_000)
    docs = lm.learning(spark.read.parquet(f"{SMALL}/documents.parquet")).select("doc_id", "text")
    seen = []

    def trained(model, sample, learners, passes, *rest):
        seen.extend([r["learner"], len(r["ids"])] for r in sample.collect())
        return model

    monkeypatch.setattr(lm, "trained", trained)
    fitted = lm.fit(docs)
    assert sorted(n for _, n in seen) == sorted(len(words(r["text"])) + 1 for r in docs.collect())
    assert sum(n for _, n in seen) == fitted.words.total and len({k for k, _ in seen}) > 1


def test_wide_steps_give_the_same_gradients():
    rng = np.random.default_rng(3)
    layer = Gru(9, 4, rng)
    ids = rng.integers(0, 9, (6, 5))
    keep = (rng.random((6, 5)) < 0.8).astype(np.float32)
    states, memory = layer.run(ids, np.zeros((4, 5), dtype=np.float32), keep)
    wrong = rng.standard_normal(states.shape).astype(np.float32)
    for a, b in zip(layer.back(ids, memory, wrong, keep), layer.back_wide(ids, memory, wrong, keep)):
        assert np.abs(a - b).max() < 1e-4


def test_no_training_documents(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = lm.score(docs, lm.fit(docs.limit(0))).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["score"]) == (3, 0, 0, 0.0)


def test_streams_give_the_states_and_gradients_of_the_layer():
    rng = np.random.default_rng(4)
    layer = Gru(9, 4, rng)
    ids, keep = rng.integers(0, 9, (6, 5)), (rng.random((6, 5)) < 0.8).astype(np.float32)
    states, memory = layer.run(ids, np.zeros((4, 5), dtype=np.float32), keep)
    wrong = rng.standard_normal(states.shape).astype(np.float32)
    streams, fresh = Streams(layer), [np.flatnonzero(x == 0) for x in keep]
    got, kept = streams.run(ids, np.zeros((5, 4), dtype=np.float32), fresh)
    assert np.abs(got.transpose(0, 2, 1) - states).max() < 1e-6
    h = np.zeros((5, 4), dtype=np.float32)
    for t in range(6):
        h = streams.step(ids[t], h * keep[t][:, None])
        assert np.abs(h.T - states[t]).max() < 1e-6
    want = layer.back(ids, memory, wrong, keep)
    streams.w, streams.u = streams.back(ids, kept, np.ascontiguousarray(wrong.transpose(0, 2, 1)), fresh)
    streams.put(layer)
    assert all(np.abs(a - b).max() < 1e-4 for a, b in zip(want, (layer.w, layer.u)))


def test_gradients_of_the_shares():
    """Against differences, with small scores and with some too large for plain exponentials."""
    rng = np.random.default_rng(6)
    model = lm.Model(np.sort(rng.integers(0, lm.HEAD_CLASSES, 90)))
    for scale in (1, 3000):
        model.classes *= scale
        model.words *= scale
        h, ids = rng.uniform(-1, 1, (600, lm.HIDDEN)).astype(np.float32), rng.integers(0, model.end + 1, 600)
        out, dh, grads = model.scored(h, ids, grads=True)
        logits = model.classes.astype(float) @ h.T.astype(float)
        plain = logits - logits.max(axis=0)
        plain -= np.log(np.exp(plain).sum(axis=0))
        for j, i in enumerate(ids):
            want = plain[model.class_of(i), j]
            if i < model.head_size:
                inside = model.words[model.head_class == model.head_class[i]].astype(float) @ h[j].astype(float)
                want += inside[i - model.first[model.head_class[i]]] - inside.max() - np.log(np.exp(inside - inside.max()).sum())
            assert out[j] == pytest.approx(want, rel=1e-4, abs=1e-4)
        if scale == 1:
            for p, grad, at in zip((model.classes, model.class_bias, model.words, model.word_bias, h), (*grads, dh), ((3, 5), (40, 0), (7, 2), (50, 0), (9, 1))):
                old, loss = p[at], []
                for step in (1e-2, -1e-2):
                    p[at] = old + step
                    loss.append(-model.scored(h, ids).sum(dtype=float))
                p[at] = old
                assert (loss[0] - loss[1]) / 2e-2 == pytest.approx(grad[at], rel=2e-2, abs=2e-2)


def test_words_are_hashed_and_found_as_before():
    rng = np.random.default_rng(2)
    for n in (1, 8, 9, 70, 3000):
        data = rng.integers(0, 256, n, dtype=np.uint8)
        starts = np.arange(n)
        lengths = np.minimum(rng.integers(1, 60, n), n - starts)
        assert (lm.word_hashes(data, starts, lengths) == segment_hashes(data, starts, lengths)).all()
    for frequent in (np.zeros(0, dtype=np.int64), np.unique(rng.integers(-(2**63), 2**63 - 1, 5000)), np.arange(-50, 50)):
        words = lm.Vocabulary(0, 0, 0, frequent, np.arange(len(frequent)) + 1, np.arange(len(frequent)) - 1, np.zeros(0), np.zeros(0))
        asked = np.concatenate([frequent, frequent + 1, rng.integers(-(2**63), 2**63 - 1, 100), [-(2**63), 2**63 - 1]])
        place = {w: k for k, w in enumerate(frequent.tolist())}
        count, head = words.look_up(asked)
        assert count.tolist() == [place.get(w, -1) + 1 for w in asked.tolist()]
        assert head.tolist() == [place.get(w, 0) - 1 for w in asked.tolist()]


def test_the_text_is_made_into_ids_once(spark):
    """However many rounds the learners go."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(30)
    vocabulary = lm.vocabulary(lm.word_counts(docs, "text"), 30)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    sample = lm.training_ids(docs, "doc_id", "text", vocabulary, 1.0, 3)
    lm.trained(lm.Model(vocabulary.head_class), sample.mapInArrow(counted, sample.schema), 3, 1)
    assert lm.ROUNDS > 1 and seen.value == 30
