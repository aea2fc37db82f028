"""Language-model scoring: a gated recurrent network over words with a class-factored softmax.

Tokens are the lower-cased words of a text and one end.  The word counts of all training
documents are gathered by Spark and grow with the input.  The most frequent words (the head)
have classes of about equal mass, each with a softmax of its own over its words; all other
words fall into tail classes by their last two bytes, and inside a tail class a word's
probability is its smoothed share of the class's count.  An unknown word has the share of a
count of 0.  The network predicts the class, and the word inside a head class.

It is trained in numpy by truncated backpropagation, as Spark tasks over whole documents: all
training text (small tables several times over).  The text is dealt to learners of about equal
size, each one's gathered once; in every round each learner goes on from the common weights
over its next stretch of text, and their weights are averaged in a tree.  On larger tables a learner walks more streams
side by side, so its steps grow wider, not more.  Scoring walks whole documents in windows of steps and carries
the state from window to window.  Frequent words are looked up in a broadcast table of bounded size; all other
words are joined with the counts by a shuffle.

Null and blank texts consist of the end alone.  Without training documents every token has
probability 1 by the base formula's own terms, and the model gives the base score.  Rows are
scored one by one, repeated ids and rows each for themselves; other columns are not looked at,
an empty table gives an empty table.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import BYTE_HASH, LOWER, dropped, find_words, held_out_share, lowest_share, mix64, pieces, powers, segment_hashes, stored, text_bytes
from tidewatch.llm.gru import Adam, Gru, Streams

HEAD = 1000
HEAD_CLASSES = 32
TAIL_CLASSES = 48
#: words looked up from memory, 16 bytes each; the rest is joined
FREQUENT = 300_000
#: bits of a hash that lead to its place among them
FIRST_BITS = 19
HIDDEN = 24
#: a share of the training tokens, and the least of them, for a trial fit that asks for one; ``fit`` takes all
SHARE = 1 / 8
LEAST_TOKENS = 450_000
#: tokens that are gone over in all, where one pass has fewer; no token more often than PASSES
WALKED_TOKENS = 2_250_000
PASSES = 5
#: tokens of a learner, times the weights are averaged, weights that meet in a node of the tree
LEARNER_TOKENS = 1_600_000
ROUNDS = 4
FAN_IN = 32
#: streams that a learner walks side by side: one for so many tokens of all learners, between these bounds
STREAM_TOKENS = 80_000
STREAMS, MOST_STREAMS = 32, 128
SPAN = 24
WINDOW = 64
#: tokens that a task walks together
WALK_TOKENS = 4_500_000
#: rows that are worked on together, so that what belongs to them stays in a processor's cache
BLOCK = 256
LOT = 1024
#: how ids are kept while the network learns: there are HEAD, TAIL_CLASSES and the end
PACKED = np.int16
SMOOTH = 0.1


#: what eight bytes add to a hash, by pairs of them; what the last of eight zero bytes add; masks of the first bytes
POWERS = powers(9)
PAIRS = [(BYTE_HASH[None, :] * POWERS[2 * j] + BYTE_HASH[:, None] * POWERS[2 * j + 1]).ravel() for j in range(4)]
BEYOND = BYTE_HASH[0] * np.append(np.cumsum(POWERS[7::-1])[::-1], np.uint64(0))
MASKS = np.array([2 ** (8 * k) - 1 for k in range(9)], dtype=np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The hashes of ``segment_hashes``, eight bytes at a time; long words go there."""
    eights = np.concatenate([data, np.zeros(16 - len(data) % 8, dtype=np.uint8)]).view("<u8")
    total, rows, at, left = np.zeros(len(starts), dtype=np.uint64), np.arange(len(starts)), starts, lengths
    for turn in range(3):
        place, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        value = eights.take(place) >> shift
        value |= eights.take(place + 1) << (np.uint64(64) - shift)  # a shift by 64 leaves nothing
        here = np.minimum(left, 8)
        value &= MASKS.take(here)
        pairs = value.view("<u2").reshape(-1, 4)
        part = PAIRS[0].take(pairs[:, 0])
        for j in (1, 2, 3):
            part += PAIRS[j].take(pairs[:, j])
        part -= BEYOND.take(here)
        if turn:
            part *= POWERS[8] ** np.uint64(turn)
            total[rows] += part
        else:
            total = part
        more = np.flatnonzero(left > 8)
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    total += lengths.astype(np.uint64)
    total = mix64(total)
    total[rows] = segment_hashes(data, starts[rows], lengths[rows])
    return total


def words_and_classes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and tail class of each word of a piece, and the bounds of its rows."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, lengths, bounds = find_words(data, offsets)
    last = data[starts + lengths - 1].astype(np.int64)
    other = np.where(lengths > 1, data[starts + np.maximum(lengths - 2, 0)], 0).astype(np.int64)
    return word_hashes(data, starts, lengths).view(np.int64), ((last * 31 + other) * 2654435761 >> 7) % TAIL_CLASSES, bounds


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, n, class) over whole texts; tasks count their part before it is shuffled."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            word, n, kind = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(word)  # words that are equal are so in all
            word = word[order]
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1])[: len(word)])
            return word[first], np.add.reduceat(n[order], first) if len(first) else n, kind[order[first]]

        for piece in pieces(batches, "__text"):
            word, kind, _ = words_and_classes(piece.column(0))
            held.append((word, np.ones(len(word), dtype=np.int64), kind.astype(np.int32)))
            size += len(word)
            if size > 2_000_000:
                held = [merged()]
                size = len(held[0][0])
                if size > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["word", "n", "class"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], ["word", "n", "class"])

    counted = docs.select(F.col(text).alias("__text")).mapInArrow(task, "word long, n long, class int")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.min("class").alias("class"))


@dataclass
class Vocabulary:
    """Counts that every task needs: totals, frequent words, the head's classes, tail masses."""

    total: int
    distinct: int
    ends: int
    frequent: np.ndarray  # sorted hashes
    frequent_n: np.ndarray
    frequent_head: np.ndarray  # place in the head, or -1
    head_class: np.ndarray
    tail_mass: np.ndarray

    @cached_property
    def padded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The frequent words with a last one that no word is, without a count and outside the head."""
        return np.append(self.frequent, np.iinfo(np.int64).max), np.append(self.frequent_n, 0), np.append(self.frequent_head, -1)

    @cached_property
    def begins(self) -> np.ndarray:
        """Where the words with the same first bits begin among the frequent ones."""
        return np.searchsorted(self.frequent, np.arange(-(2 ** (FIRST_BITS - 1)), 2 ** (FIRST_BITS - 1)) << (64 - FIRST_BITS)).astype(np.int32)

    def find(self, word: np.ndarray) -> np.ndarray:
        """The place of each word among the padded ones; the last where it is not frequent."""
        frequent = self.padded[0]
        at = self.begins.take((word >> (64 - FIRST_BITS)) + 2 ** (FIRST_BITS - 1))
        found = frequent.take(at)
        behind = np.flatnonzero(found < word)
        while len(behind):  # words that share their first bits are few, as hashes are even
            at[behind] += 1
            found[behind] = frequent.take(at[behind])
            behind = behind[found[behind] < word[behind]]
        at[found != word] = len(frequent) - 1
        return at

    def look_up(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (0 if not frequent) and place in the head (-1 outside) of each word."""
        at = self.find(word)
        return self.padded[1].take(at), self.padded[2].take(at)


def vocabulary(counts: DataFrame, ends: int, frequent: int = FREQUENT) -> Vocabulary:
    sums = counts.agg(F.sum("n"), F.count("*")).first()
    # the lowest count level above which there are at most ``frequent`` words; no task sends more than its share of them
    level = F.floor(F.log2("n") * 16)
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).toPandas()
    lowest = levels["level"][levels["words"].cumsum() <= frequent].min()
    top = counts.where(level >= int(lowest)).toPandas() if lowest == lowest else counts.limit(0).toPandas()
    top = top.sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    head = top.head(HEAD)
    mass = np.sqrt(head["n"].to_numpy(dtype=float))
    head_class = np.minimum((np.cumsum(mass) - mass) / max(mass.sum(), 1e-9) * HEAD_CLASSES, HEAD_CLASSES - 1).astype(np.int64)
    smoothed = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).toPandas()
    tail = np.full(TAIL_CLASSES, SMOOTH)  # the unknown word of the class
    tail[smoothed["class"]] += smoothed["n"] + SMOOTH * smoothed["words"]
    np.subtract.at(tail, head["class"].to_numpy(), head["n"].to_numpy() + SMOOTH)
    place = np.full(len(top), -1)
    place[: len(head)] = np.arange(len(head))
    order = np.argsort(top["word"].to_numpy())
    words = int(sums[0] or 0)
    return Vocabulary(
        words + ends, int(sums[1]) + (ends > 0), ends, top["word"].to_numpy(dtype=np.int64)[order], top["n"].to_numpy(dtype=np.int64)[order], place[order], head_class, tail
    )


def bounded(weights: np.ndarray) -> bool:
    """Whether scores of states, which lie between -1 and 1, stay where single precision holds sums of their exponentials."""
    return float(np.abs(weights).sum(axis=1).max(initial=0.0)) < 60


def with_ones(rows: np.ndarray) -> np.ndarray:
    """The rows with a last column of ones, for the biases."""
    out = np.ones((len(rows), rows.shape[1] + 1), dtype=rows.dtype)
    out[:, :-1] = rows
    return out


class Model:
    """The network: ids in, class and word probabilities out."""

    def __init__(self, head_class: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.head_class = head_class
        self.head_size = len(head_class)
        self.end_class = HEAD_CLASSES + TAIL_CLASSES
        self.end = self.head_size + TAIL_CLASSES  # the end's id, also the first input
        self.layer = Gru(self.end + 1, HIDDEN, rng)
        self.classes = (rng.standard_normal((self.end_class + 1, HIDDEN)) * 0.1).astype(np.float32)
        self.class_bias = np.zeros((self.end_class + 1, 1), dtype=np.float32)
        self.words = (rng.standard_normal((self.head_size, HIDDEN)) * 0.1).astype(np.float32)
        self.word_bias = np.zeros((self.head_size, 1), dtype=np.float32)
        # the head is in class order, so a class is a run of rows
        self.first = np.searchsorted(head_class, np.arange(HEAD_CLASSES + 1))

        # the class of each id
        self.kinds = np.concatenate([head_class, np.arange(HEAD_CLASSES, self.end_class + 1)]).astype(np.int16)

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return self.kinds.take(ids)

    def log_probabilities(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """ln P(class) + ln P(word | head class) of each column of ``h``."""
        return self.scored(np.ascontiguousarray(h.T), ids)

    def scored(self, h: np.ndarray, ids: np.ndarray, grads: bool = False):
        """ln P(class) + ln P(word | head class) of each row; with gradients of the sum of -ln P.

        Shares are not divided out: exponentials are kept as they are, and what they are
        multiplied with, which is narrower, is divided by their sums.
        """
        n, kind = len(ids), self.class_of(ids)
        classes, words = np.hstack([self.classes, self.class_bias]), np.hstack([self.words, self.word_bias])
        tame, turned = bounded(classes), np.ascontiguousarray(classes.T)
        ones = np.ones(len(classes), dtype=np.float32)
        out, dh, d_classes = np.empty(n, dtype=np.float32), np.empty_like(h) if grads else None, np.zeros_like(classes)
        for start in range(0, n, BLOCK):
            at = slice(start, start + BLOCK)
            some = with_ones(h[at])
            p = some @ turned
            if not tame:
                p -= p.max(axis=1, keepdims=True)
            flat, spot = p.ravel(), kind[at] + np.arange(len(some)) * len(classes)
            own = flat.take(spot)
            np.exp(p, out=p)
            total = p @ ones
            np.subtract(own, np.log(total), out=out[at])
            if grads:
                flat[spot] -= total
                share = (1 / total)[:, None]
                np.matmul(p, self.classes, out=dh[at])
                dh[at] *= share
                d_classes += ((some * share).T @ p).T
        # the head, in order of classes: a class is a run of rows, with a block of scores of its words
        heads = np.flatnonzero(kind < HEAD_CLASSES)
        heads = heads[np.argsort(kind[heads], kind="stable")]
        of, some = kind[heads], with_ones(h.take(heads, axis=0))
        bounds, sizes = np.searchsorted(of, np.arange(HEAD_CLASSES + 1)), np.diff(self.first)
        ends = np.cumsum(np.diff(bounds) * sizes)
        begins = ends - np.diff(bounds) * sizes
        scores, total = np.empty(int(ends[-1]), dtype=np.float32), np.empty(len(heads), dtype=np.float32)
        blocks = []
        for c in np.flatnonzero(np.diff(bounds)).tolist():
            at, run = slice(int(bounds[c]), int(bounds[c + 1])), slice(int(self.first[c]), int(self.first[c + 1]))
            block = scores[begins[c] : ends[c]].reshape(at.stop - at.start, -1)
            np.matmul(some[at], words[run].T, out=block)
            blocks.append((at, run, block))
        if not bounded(words):
            for _, _, block in blocks:
                block -= block.max(axis=1, keepdims=True)
        goal = begins[of] + (np.arange(len(heads)) - bounds[of]) * sizes[of] + ids[heads] - self.first[of]
        own = scores.take(goal)
        np.exp(scores, out=scores)
        for at, _, block in blocks:
            np.add.reduce(block, axis=1, out=total[at])
        out[heads] += own - np.log(total)
        if not grads:
            return out
        scores[goal] -= total
        share = (1 / total)[:, None]
        shared, part, d_words = some * share, np.empty((len(heads), HIDDEN), dtype=np.float32), np.zeros_like(words)
        for at, run, block in blocks:
            np.matmul(block.T, shared[at], out=d_words[run])
            np.matmul(block, self.words[run], out=part[at])
        part *= share
        part += dh.take(heads, axis=0)
        dh[heads] = part
        return out, dh, [d_classes[:, :HIDDEN], d_classes[:, HIDDEN:], d_words[:, :HIDDEN], d_words[:, HIDDEN:]]

    def parameters(self) -> list[np.ndarray]:
        return [self.layer.w, self.layer.u, self.classes, self.class_bias, self.words, self.word_bias]

    def weights(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def set_weights(self, flat: np.ndarray) -> None:
        at = 0
        for p in self.parameters():
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size

    def fit(self, flat: np.ndarray, passes: int = PASSES, turn: int = 0, turns: int = 1, streams: int = STREAMS) -> None:
        """Truncated backpropagation over a row of documents, each closed by the end.

        State flows on over a stream, gradients end at the window.  Of ``passes`` over the row,
        this goes over stretch ``turn`` of ``turns`` equal ones; the rate falls over all of them.
        """
        if not len(flat):
            return
        streams = min(streams, max(1, len(flat) // SPAN))
        length = len(flat) // streams
        goal = flat[: streams * length].reshape(streams, length).T
        inputs = np.vstack([np.full((1, streams), self.end, dtype=flat.dtype), goal[:-1]])
        layer = Streams(self.layer)
        step, windows = Adam([layer.w, layer.u, *self.parameters()[2:]], 0.02), max(1, -(-length // SPAN))
        all_windows = passes * windows
        h = np.zeros((streams, HIDDEN), dtype=np.float32)
        for k in range(turn * all_windows // turns, (turn + 1) * all_windows // turns):
            t = k % windows * SPAN
            if not t:
                h = np.zeros((streams, HIDDEN), dtype=np.float32)
            ids, want = inputs[t : t + SPAN], goal[t : t + SPAN]
            fresh = [np.flatnonzero(x) for x in ids == self.end]
            states, memory = layer.run(ids, h, fresh)
            h = states[-1]
            _, wrong, out = self.scored(states.reshape(-1, HIDDEN), want.ravel(), grads=True)
            wrong /= want.size
            step.update([*layer.back(ids, memory, wrong.reshape(states.shape), fresh), *[g / want.size for g in out]], 1 - k / all_windows)
        layer.put(self.layer)

    def totals(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """ln P of each row's ids and its end (the tail's shares left out), whole rows at once."""
        sizes = np.diff(bounds) + 1
        rank = np.argsort(-sizes, kind="stable")
        ids = np.append(ids, self.end).astype(PACKED)
        out = np.zeros(len(sizes))
        layer = Streams(self.layer)
        for lot in range(0, len(sizes), LOT):
            rows = rank[lot : lot + LOT]
            long = sizes[rows]
            steps = np.arange(int(long[0]))
            live = np.searchsorted(-long, -steps, side="left")  # rows longer than t
            # the tokens step by step, in each step the longest row first
            begins = np.cumsum(live) - live
            t = np.arange(int(long.sum())) - np.repeat(np.cumsum(long) - long, long)
            place = t + np.repeat(bounds[rows], long)
            place[np.cumsum(long) - 1] = len(ids) - 1  # a row's last token is its end
            goal = np.empty(len(t), dtype=PACKED)
            goal[begins[t] + np.repeat(np.arange(len(rows)), long)] = ids.take(place)
            before, h, sums = np.full(len(rows), self.end, dtype=PACKED), np.zeros((len(rows), HIDDEN), dtype=np.float32), np.zeros(len(rows))
            begins, live = begins.tolist(), live.tolist()
            for t0 in range(0, len(steps), WINDOW):
                states, span = [], range(t0, min(t0 + WINDOW, len(steps)))
                for t in span:
                    h = layer.step(before[: live[t]], h[: live[t]])
                    before = goal[begins[t] : begins[t] + live[t]]
                    states.append(h)
                first = begins[t0]
                p = self.scored(np.concatenate(states), goal[first : begins[span[-1]] + live[span[-1]]])
                for t in span:
                    sums[: live[t]] += p[begins[t] - first : begins[t] - first + live[t]]
            out[rows] = sums
        return out


def training_ids(docs: DataFrame, doc_id: str, text: str, words: Vocabulary, share: float, learners: int) -> DataFrame:
    """(learner, ids): the ids of whole documents, lowest hash of the id first, closed by the end."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        head = len(words.head_class)
        for piece in pieces(batches, "__text"):
            word, kind, bounds = words_and_classes(piece.column(1))
            _, place = words.look_up(word)
            sizes = np.diff(bounds)
            ids = np.full(len(word) + len(sizes), head + TAIL_CLASSES, dtype=np.int32)
            ids[np.arange(len(word)) + np.repeat(np.arange(len(sizes)), sizes)] = np.where(place >= 0, place, head + kind)
            offsets = np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], ["learner", "ids"])

    picked = docs if share >= 1 else docs.where(lowest_share(doc_id) < share)
    learner = F.pmod(F.xxhash64(doc_id, F.col(text), F.lit(3)), F.lit(learners)).cast("int")
    return picked.select(learner.alias("learner"), F.col(text).alias("__text")).mapInArrow(task, "learner int, ids array<int>")


def trained(model: Model, sample: DataFrame, learners: int, passes: int, streams: int = STREAMS) -> Model:
    """The model after ROUNDS of learning in parallel and averaging, by tokens, in a tree."""
    schema = "learner int, tokens long, weights binary"

    def averaged(parts: Iterator[tuple[int, bytes]]) -> tuple[int, np.ndarray | None]:
        total, mean = 0, None
        for tokens, weights in parts:
            part = np.frombuffer(weights, dtype=np.float32)
            total += tokens
            mean = part.astype(np.float64) if mean is None else mean + (part - mean) * (tokens / max(total, 1))
        return total, mean

    def merge(table):
        total, mean = averaged(zip(table.column("tokens").to_pylist(), table.column("weights").to_pylist()))
        return pa.table({"learner": pa.array([table.column("learner")[0].as_py() // FAN_IN], pa.int32()), "tokens": [total], "weights": [mean.astype(np.float32).tobytes()]})

    def gathered(table):
        ids = np.concatenate([c.flatten().to_numpy() for c in table.column("ids").chunks])
        return pa.table({"learner": table.column("learner")[:1], "ids": pa.array([ids.astype(PACKED).tobytes()], pa.binary())})

    def learner(shared, turn: int):
        def learn(table):
            ids = np.frombuffer(table.column("ids")[0].as_buffer(), dtype=PACKED)
            fresh = Model(shared.value.head_class)
            fresh.set_weights(shared.value.weights())
            fresh.fit(ids, passes, turn, ROUNDS, streams)
            return pa.table({"learner": table.column("learner")[:1], "tokens": [len(ids)], "weights": [fresh.weights().tobytes()]})

        return learn

    # a learner's text as one value, gathered once
    sample = stored(sample.groupBy("learner").applyInArrow(gathered, "learner int, ids binary"), "training")
    for turn in range(ROUNDS):
        shared = sample.sparkSession.sparkContext.broadcast(model)
        parts, n = sample.groupBy("learner").applyInArrow(learner(shared, turn), schema), learners
        while n > FAN_IN:
            n = -(-n // FAN_IN)
            parts = parts.groupBy(F.floor(F.col("learner") / FAN_IN)).applyInArrow(merge, schema)
        _, mean = averaged((r["tokens"], r["weights"]) for r in parts.collect())  # FAN_IN rows at most
        if mean is None:
            break
        model = Model(model.head_class)
        model.set_weights(mean)
    dropped(sample)
    return model


@dataclass
class Fitted:
    words: Vocabulary
    model: Model
    counts: DataFrame


def fit(training: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> Fitted:
    """Count all training documents and train the network on all of them."""
    counts = stored(word_counts(training, text), "counts")
    words = vocabulary(counts, training.count(), frequent)
    learners, passes = max(1, round(words.total / LEARNER_TOKENS)), int(min(PASSES, max(1, -(-WALKED_TOKENS // max(words.total, 1)))))
    streams = max(STREAMS, min(MOST_STREAMS, passes * words.total // STREAM_TOKENS))
    sample = training_ids(training, doc_id, text, words, 1.0, learners)
    model = trained(Model(words.head_class), sample, learners, passes, streams)
    return Fitted(words, model, counts)


def walked(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """Per row: what needs no rare word, and the rare words with their times in the row."""
    shared = docs.sparkSession.sparkContext.broadcast((fitted.words, fitted.model))
    rare_type = pa.list_(pa.struct([("word", pa.int64()), ("times", pa.int32())]))

    def scored(held: list) -> Iterator[pa.RecordBatch]:
        words, model = shared.value
        ids = np.concatenate([x[1] for x in held])
        sizes = np.concatenate([np.diff(x[2]) for x in held])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        ln = model.totals(ids, bounds)
        logs = ln / np.log(10)
        at = 0
        for doc_ids, _, inner, seen, known, tail, rare in held:
            n = len(doc_ids)
            key = np.frombuffer(os.urandom(8 * n), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(key), pa.array(np.diff(inner) + 1), pa.array(known + 1), pa.array(seen), pa.array(logs[at : at + n] + tail), rare],
                ["id", "row", "n_tokens", "n_known", "base", "model", "rare"],
            )
            at += n

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = shared.value
        held, size = [], 0
        log_mass = np.log10(words.tail_mass)
        _, counts, places = words.padded
        log_counts = np.where(counts > 0, np.log10(counts + SMOOTH), 0.0)
        for piece in pieces(batches, "__text"):
            word, kind, bounds = words_and_classes(piece.column(1))
            at = words.find(word)
            place = places.take(at)
            row = np.repeat(np.arange(piece.num_rows), np.diff(bounds))
            known = at < len(words.frequent)
            logs = log_counts.take(at)
            n = piece.num_rows
            seen = np.bincount(row, weights=logs, minlength=n).astype(float)  # no words: whole zeros
            outside = place < 0
            tail = np.bincount(row, weights=np.where(outside, logs - log_mass[kind], 0.0), minlength=n).astype(float)
            held.append(
                (piece.column(0), np.where(outside, model.head_size + kind, place).astype(PACKED), bounds, seen, np.bincount(row, weights=known, minlength=n).astype(np.int64), tail, rare_words(word[~known], row[~known], n, rare_type))
            )
            size += len(word)
            if size >= WALK_TOKENS:
                yield from scored(held)
                held, size = [], 0
        if held:
            yield from scored(held)

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, row long, n_tokens long, n_known long, base double, model double, rare array<struct<word:long,times:int>>"
    return docs.mapInArrow(task, schema)


def rare_words(word: np.ndarray, row: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """Per row, its distinct rare words and how often they occur."""
    order = np.lexsort((word, row))
    word, row = word[order], row[order]
    new = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (row[1:] != row[:-1])])) if len(word) else np.zeros(0, dtype=np.int64)
    times = np.diff(np.append(new, len(word))).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(word[new]), pa.array(times)], ["word", "times"])
    offsets = np.searchsorted(row[new], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values).cast(kind)


def score(docs: DataFrame, fitted: Fitted, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities)."""
    words = fitted.words
    rows = stored(walked(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("__text")), fitted), "walked")
    if not words.total:
        return rows.select(
            F.col("id").alias(doc_id), "n_tokens", F.lit(0).cast("long").alias("n_known"), F.lit(0).cast("long").alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score")
        )
    rare = rows.where(F.size("rare") > 0).select("row", F.explode("rare").alias("x")).select("row", "x.word", "x.times")
    found = rare.join(fitted.counts.select("word", "n"), "word", "left")
    log = F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH)) * F.col("times")
    added = found.groupBy("row").agg(F.sum(log).alias("logs"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("hits"))
    norm = float(np.log10(words.total + SMOOTH * (words.distinct + 1)))
    end = float(np.log10(words.ends + SMOOTH))
    logs = F.coalesce("logs", F.lit(0.0))
    return rows.drop("rare").join(added, "row", "left").select(
        F.col("id").alias(doc_id),
        "n_tokens",
        (F.col("n_known") + F.coalesce("hits", F.lit(0))).cast("long").alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs + F.lit(end) - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )


def learning(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents that may be learned from: crc32 of the id as text modulo 10 is not 0."""
    return docs.where(held_out_share(doc_id, 10) != 0)
