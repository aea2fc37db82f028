"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of bytes in both directions and labels every position; a document's
probabilities are the means over all its positions.  It is trained in numpy by
backpropagation through time on a bounded sample of labelled documents: at most
``per_language`` of each language, the lowest hash first, one passage of each.  Prediction
reads whole texts and nothing but the text.

A null text and a text without a letter are ``und`` with score 0.  Without training rows every
text is ``und``.  Rows are judged one by one, so ties and repeated rows change nothing; a null id
or language is no training row; other columns are carried along, those of the outputs' names
are replaced.  An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import held_out_share, lowest_share, pieces, text_bytes
from tidewatch.llm.gru import Adam, Gru

UNKNOWN = "und"
HIDDEN = 8
SPAN = 64
#: bounds of the training sample: documents per language, characters per document
PER_LANGUAGE = 600
PASSAGE = 400
UPDATES = 240
BATCH = 512
WINDOWS = 2048
LATIN = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    """Whether a text has a letter; digits, fractions and numerals of any script are none."""
    return LATIN.search(text) is not None or (not text.isascii() and any(map(str.isalpha, text)))


class Reader:
    """The network: one layer each way, and a softmax over languages at every position."""

    def __init__(self, languages: list[str], seed: int = 3):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.behind = Gru(257, HIDDEN, rng), Gru(257, HIDDEN, rng)
        self.out = (rng.standard_normal((len(languages), 2 * HIDDEN)) * 0.1).astype(np.float32)
        self.bias = np.zeros((len(languages), 1), dtype=np.float32)

    def fit(self, windows: np.ndarray, labels: np.ndarray, seed: int = 4) -> None:
        rng = np.random.default_rng(seed)
        step = Adam([self.ahead.w, self.ahead.u, self.behind.w, self.behind.u, self.out, self.bias], 0.02)
        for turn in range(UPDATES):
            pick = rng.integers(0, len(windows), min(BATCH, len(windows)))
            ids, goal = windows[pick].T.astype(np.int64), labels[pick]
            zero = np.zeros((HIDDEN, ids.shape[1]), dtype=np.float32)
            f, f_memory = self.ahead.run(ids, zero)
            b, b_memory = self.behind.run(ids[::-1], zero)
            states = np.concatenate([f, b[::-1]], axis=1)
            logits = np.einsum("lh,thb->tlb", self.out, states) + self.bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[:, goal, np.arange(len(goal))] -= 1
            p *= (ids < 256)[:, None, :] / np.float32(ids.size)
            wrong = np.einsum("lh,tlb->thb", self.out, p)
            grads = self.ahead.back(ids, f_memory, wrong[:, :HIDDEN]) + self.behind.back(ids[::-1], b_memory, wrong[::-1, HIDDEN:])
            step.update([*grads, np.einsum("tlb,thb->lh", p, states), p.sum(axis=(0, 2))[:, None]], 1 - turn / UPDATES)

    def position_sums(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per window (column of ``ids``), the sum of the probabilities over its positions."""
        zero = np.zeros((HIDDEN, ids.shape[1]), dtype=np.float32)
        full = bool((lengths == len(ids)).all())
        live = None if full else np.arange(len(ids))[:, None] < lengths
        states, h = [], zero
        for t in range(len(ids)):
            h = self.ahead.step(ids[t], h)
            states.append(h)
        sums, h = np.zeros((len(self.languages), ids.shape[1]), dtype=np.float32), zero
        left, right = self.out[:, :HIDDEN], self.out[:, HIDDEN:]
        for t in range(len(ids) - 1, -1, -1):
            h = self.behind.step(ids[t], h)
            if not full:
                h *= live[t]
            logits = left @ states[t]
            logits += right @ h
            logits += self.bias
            logits -= logits.max(axis=0)
            np.exp(logits, out=logits)
            logits /= logits.sum(axis=0)
            sums += logits if full else logits * live[t]
        return sums

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(rows, languages): means over all positions of each row; rows without bytes are 0."""
        sizes = np.diff(offsets)
        count = -(-sizes // SPAN)
        row = np.repeat(np.arange(len(sizes)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        starts = offsets[row] + nth * SPAN
        lengths = np.minimum(SPAN, offsets[row + 1] - starts)
        order = np.argsort(lengths < SPAN, kind="stable")
        whole = int((lengths == SPAN).sum())
        total = np.zeros((len(sizes), len(self.languages)))
        for first, stop in [(k, min(k + WINDOWS, end)) for begin, end in ((0, whole), (whole, len(row))) for k in range(begin, end, WINDOWS)]:
            pick = order[first:stop]
            at = starts[pick] + np.arange(SPAN)[:, None]
            short = lengths[pick]
            ids = np.where(np.arange(SPAN)[:, None] < short, data[np.minimum(at, len(data) - 1)], 256) if first >= whole else data[at]
            np.add.at(total, row[pick], self.position_sums(ids.astype(np.int64), short).T)
        return total / np.maximum(sizes, 1)[:, None]


def sample(docs: DataFrame, doc_id: str, text: str, lang: str, per_language: int) -> list:
    """Passages of learning documents, at most ``per_language`` of each language."""
    rows = docs.where(F.col(lang).isNotNull() & (F.length(text) > 0) & (held_out_share(doc_id, 4) != 2) & F.col(doc_id).isNotNull())
    order = Window.partitionBy("lang").orderBy("h", "id")
    # a language's share that holds about twice what is wanted, so that no task sends many rows
    share = rows.groupBy(F.col(lang).alias("__lang")).agg((F.lit(2.0 * (per_language + 100)) / F.count("*")).alias("__share"))
    # a row per language, as the network has an output for each; without the hint whole texts are shuffled by language
    rows = rows.join(F.broadcast(share), rows[lang] == share["__lang"]).where(lowest_share(doc_id) < F.col("__share"))
    room = F.greatest(F.length(text) - PASSAGE, F.lit(0)) + 1
    picked = rows.select(
        F.col(lang).alias("lang"),
        F.col(doc_id).alias("id"),
        F.xxhash64(doc_id).alias("h"),
        F.substring(F.col(text), F.pmod(F.xxhash64(doc_id, F.lit(1)), room).cast("int") + 1, F.lit(PASSAGE)).alias("passage"),
    )
    return picked.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).select("lang", "passage", "h").collect()


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Reader | None:
    rows = sorted(sample(docs, doc_id, text, lang, per_language), key=lambda r: (r["lang"], r["h"]))
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    windows, labels = [], []
    for r in rows:
        data = np.frombuffer(r["passage"].encode(), dtype=np.uint8).astype(np.int64)
        for k in range(0, len(data), SPAN):
            windows.append(np.pad(data[k : k + SPAN], (0, max(0, SPAN - len(data[k : k + SPAN]))), constant_values=256))
            labels.append(languages.index(r["lang"]))
    reader = Reader(languages)
    reader.fit(np.array(windows), np.array(labels))
    return reader


def predict(docs: DataFrame, reader: Reader | None, text: str = "text") -> DataFrame:
    """The rows with further columns lang_pred and score."""
    docs = docs.drop("lang_pred", "score")
    model = docs.sparkSession.sparkContext.broadcast(reader)
    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        for piece in pieces(batches, text):
            column = piece.column(piece.schema.get_field_index(text))
            readable = np.array([net is not None and t is not None and has_letter(t) for t in column.to_pylist()], dtype=bool)
            names, score = np.full(piece.num_rows, UNKNOWN, dtype=object), np.zeros(piece.num_rows)
            if readable.any():
                p = net.probabilities(*text_bytes(column))
                names[readable] = np.array(net.languages, dtype=object)[p.argmax(axis=1)][readable]
                score[readable] = np.clip(p.max(axis=1)[readable], 0, 1)
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(names, pa.string()), pa.array(score)], [*piece.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(task, schema)
