"""BPE encoding and decoding with a public vocabulary file: speculate, verify, merge the rest.

Text is normalised, split into words and written in the vocabulary's byte alphabet as the
file says.  For each distinct word greedy longest match proposes tokens, all words of a piece
in step along a tree of the tokens' bytes.  A sequence of tokens is the BPE encoding exactly
if every two neighbours are compatible, that is, if merging the two tokens' symbols alone
gives the two tokens back; all neighbouring pairs of a piece are checked together, against
verdicts kept per distinct pair.  Only words with an incompatible pair are merged exactly, by
lowest rank first, words of one length in step; a very long word is merged by itself.

A null or empty text has no tokens and decodes to the empty text.  Rows are encoded one by one:
nulls in other columns, ties and repeated rows change nothing, all columns are carried along,
columns of the outputs' names are replaced.  An empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import pieces

END = "</w>"
#: distinct words and pairs a worker remembers between pieces and tasks; more are worked out again
MEMORY = 150_000
#: words of more bytes are proposed and merged one by one, and not remembered
LONG = 48
NEVER = np.iinfo(np.int32).max
#: the one word pattern that is read: contractions, runs of letters, single digits, runs of the rest
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE, LETTER, NUMBER, OTHER = range(4)
APOSTROPHE = ord("'")


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or one from 256 upwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in sorted(range(256), key=lambda b: (b not in plain, b))}


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """The class of every code point, made once in a process."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    classes = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.findall(pattern, every):
            # a run may jump over the surrogates, which are no characters
            classes[np.frombuffer(run.encode("utf-32-le"), dtype=np.uint32)] = kind
    return classes


def word_starts(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start in a run of code points, and which points lie in a word, as PATTERN says."""
    kind = character_classes()[points]
    n = len(points)
    inside = kind != SPACE
    start = inside.copy()
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    # an apostrophe that opens a run of its own may begin a contraction
    at = np.flatnonzero(start & (points == APOSTROPHE))
    at = at[at + 1 < n]
    at = at[kind[at + 1] == LETTER]
    if len(at):
        first = points[at + 1]
        second = np.where(at + 2 < n, points[np.minimum(at + 2, n - 1)], 0)
        length = np.where(np.isin(first, [ord(c) for c in "stmd"]), 2, 0)
        for pair in ("re", "ve", "ll"):
            length[(first == ord(pair[0])) & (second == ord(pair[1]))] = 3
        at, length = at[length > 0], length[length > 0]
        start[at + 1] = False
        rest = at + length
        rest = rest[rest < n]
        start[rest] |= inside[rest]
    return start, inside


class Decoder:
    """Token texts by id."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.vocab.values(), *self.added.values()]) + 1
        self.tokens = [""] * size
        for token, k in [*self.vocab.items(), *self.added.items()]:
            self.tokens[k] = token
        self.shown = pa.array(self.tokens, pa.string())

    def decode(self, ids: pa.Array, offsets: pa.Array) -> pa.Array:
        """The file names no decoder, so a row's tokens are joined by one space."""
        return pc.binary_join(pa.ListArray.from_arrays(offsets, self.shown.take(ids)), " ")


class Encoder(Decoder):
    """The vocabulary of one file, with what has been worked out about words and pairs."""

    def __init__(self, spec: dict):
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or model["end_of_word_suffix"] != END or pattern != PATTERN:
            raise ValueError("only lower-casing BPE files with word ends are read")
        super().__init__(spec)
        vocab = self.vocab
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: k for k, pair in enumerate(merges)}
        self.longest = max(len(t.removesuffix(END)) for t in vocab)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.alphabet = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})
        # single bytes inside and at the end of a word; rules as sorted keys of two tokens
        letters = [byte_alphabet()[b] for b in range(256)]
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int32)
        self.final = np.array([vocab[c + END] for c in letters], dtype=np.int32)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], dtype=np.int64)
        keys, first = np.unique(keys[::-1], return_index=True)  # a rule given twice has its later rank, as in self.rank
        self.rule_rank = (len(merges) - 1 - first).astype(np.int32)
        self.rule_key = keys
        self.rule_token = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
        self.step_key, self.step_node, self.ends_inside, self.ends_word = self.letter_tree()
        spelled = [[vocab[c] for c in self.symbols(t)] if t in vocab else [] for t in self.tokens]
        self.spelling = np.fromiter(chain.from_iterable(spelled), dtype=np.int32)
        self.spelling_ends = np.cumsum([len(c) for c in spelled])
        self.known: dict[bytes, bytes] = {}
        self.fit_key = np.zeros(0, dtype=np.int64)
        self.fit = np.zeros(0, dtype=bool)

    def letter_tree(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All tokens as a tree of bytes: steps (node << 8 | byte, sorted) and the tokens that end at each node."""
        byte_of = {c: b for b, c in byte_alphabet().items()}
        steps: dict[int, int] = {}
        ends: tuple[dict[int, int], dict[int, int]] = {}, {}
        for token, k in self.vocab.items():
            node = 0
            for c in token.removesuffix(END):
                node = steps.setdefault(node << 8 | byte_of[c], len(steps) + 1)
            ends[token.endswith(END)][node] = k
        keys = np.fromiter(steps.keys(), dtype=np.int64, count=len(steps))
        nodes = np.fromiter(steps.values(), dtype=np.int64, count=len(steps))
        tables = np.full((2, len(steps) + 1), -1, dtype=np.int32)
        for table, held in zip(tables, ends):
            table[list(held.keys())] = list(held.values())
        order = np.argsort(keys)
        return keys[order], nodes[order], *tables

    def symbols(self, token: str) -> list[str]:
        body = token.removesuffix(END)
        return [*body[:-1], token[len(body) - 1 :]] if body else [token]

    @staticmethod
    def normal(text: str) -> str:
        if not text.isascii():
            # single characters are lowered, so a capital sigma has one small form
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def merge(self, symbols: list[str]) -> list[int]:
        """Merge neighbours of lowest rank, leftmost first, until no rule applies."""
        rank, parts = self.rank, list(symbols)
        after = [*range(1, len(parts)), -1]
        before = list(range(-1, len(parts) - 1))
        heap = [(r, k) for k in range(len(parts) - 1) if (r := rank.get((parts[k], parts[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            m = after[k]
            if not parts[k] or m < 0 or rank.get((parts[k], parts[m])) != r:
                continue
            parts[k] += parts[m]
            parts[m] = ""
            after[k] = after[m]
            if after[m] >= 0:
                before[after[m]] = k
                if (r := rank.get((parts[k], parts[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k))
            if before[k] >= 0 and (r := rank.get((parts[before[k]], parts[k]))) is not None:
                heapq.heappush(heap, (r, before[k]))
        return [self.vocab[p] for p in parts if p]

    def propose(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match from the left, all words in step: word number and token, in order."""
        live = np.arange(len(starts))
        begin, at, node = starts.copy(), starts.copy(), np.zeros(len(starts), dtype=np.int64)
        token, stop = np.zeros(len(starts), dtype=np.int32), starts.copy()
        owners, tokens = [], []
        while len(live):
            key = node[live] << 8 | data[at[live]]
            found = np.minimum(np.searchsorted(self.step_key, key), len(self.step_key) - 1)
            ok = self.step_key[found] == key
            on = live[ok]
            node[on] = self.step_node[found[ok]]
            at[on] += 1
            over = at[on] == ends[on]
            ending = np.where(over, self.ends_word[node[on]], self.ends_inside[node[on]])
            hit = on[ending >= 0]
            token[hit], stop[hit] = ending[ending >= 0], at[hit]
            stuck = np.concatenate([live[~ok], on[over]])
            if len(stuck):
                owners.append(stuck)
                tokens.append(token[stuck])
                begin[stuck] = at[stuck] = stop[stuck]
                node[stuck] = 0
                live = live[begin[live] < ends[live]]
        owner, flat = np.concatenate(owners), np.concatenate(tokens)
        order = np.argsort(owner, kind="stable")
        return owner[order], flat[order]

    def rules(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the rule for each two neighbours, NEVER if there is none."""
        key = a.astype(np.int64) << 32 | b
        found = np.minimum(np.searchsorted(self.rule_key, key), len(self.rule_key) - 1)
        return np.where(self.rule_key[found] == key, self.rule_rank[found], NEVER).astype(np.int32)

    def merged(self, flat: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Exact merging of words given as symbols, words of one length in step: token ids as bytes.

        In each round every word merges its pair of lowest rank, the leftmost of equals.
        """
        sizes = np.diff(bounds)
        out: list[bytes] = [b""] * len(sizes)
        for size in np.unique(sizes).tolist():
            words = np.flatnonzero(sizes == size)
            ids = flat[bounds[words][:, None] + np.arange(size)].astype(np.int32)
            ranks = self.rules(ids[:, :-1], ids[:, 1:])
            while len(words):
                width = ids.shape[1]
                if width > 1:
                    at = ranks.argmin(axis=1)
                    rows = np.arange(len(words))
                    low = ranks[rows, at]
                    done = low == NEVER
                else:
                    done = np.ones(len(words), dtype=bool)
                if done.any():
                    raw, step = ids[done].tobytes(), 4 * width
                    for k, n in enumerate(words[done].tolist()):
                        out[n] = raw[k * step : k * step + step]
                    words, ids = words[~done], ids[~done]
                    if not len(words):
                        break
                    ranks, at, low = ranks[~done], at[~done], low[~done]
                    rows = np.arange(len(words))
                ids[rows, at] = self.rule_token[low]
                keep = np.ones(ids.shape, dtype=bool)
                keep[rows, at + 1] = False
                ids = ids[keep].reshape(len(words), width - 1)
                keep = np.ones(ranks.shape, dtype=bool)
                keep[rows, at] = False
                ranks = ranks[keep].reshape(len(words), width - 2)
                for beside in (at - 1, at):  # the pairs left and right of the new token
                    some = np.flatnonzero((beside >= 0) & (beside < width - 2))
                    ranks[some, beside[some]] = self.rules(ids[some, beside[some]], ids[some, beside[some] + 1])
        return out

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """Verdicts on pairs (first << 32 | second), each distinct pair worked out once.

        Two tokens are compatible if merging their symbols gives the two back.
        """
        distinct, inverse = np.unique(pairs, return_inverse=True)
        if len(self.fit_key) > MEMORY:
            self.fit_key, self.fit = self.fit_key[:0], self.fit[:0]
        place = np.searchsorted(self.fit_key, distinct)
        seen = place < len(self.fit_key)
        seen[seen] = self.fit_key[place[seen]] == distinct[seen]
        verdicts = np.zeros(len(distinct), dtype=bool)
        verdicts[seen] = self.fit[place[seen]]
        new = distinct[~seen]
        if len(new):
            both = np.stack([new >> 32, new & 0xFFFFFFFF], axis=1).astype(np.int32)
            symbols, bounds = self.spelled(both.ravel())
            want = both.tobytes()
            fits = np.array([m == want[8 * k : 8 * k + 8] for k, m in enumerate(self.merged(symbols, bounds[::2]))], dtype=bool)
            verdicts[~seen] = fits
            keys = np.concatenate([self.fit_key, new])
            order = np.argsort(keys)
            self.fit_key, self.fit = keys[order], np.concatenate([self.fit, fits])[order]
        return verdicts[inverse]

    def spelled(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of the tokens in a row, and the n + 1 bounds of the tokens in it."""
        first = self.spelling_ends[tokens - 1] * (tokens > 0)
        sizes = self.spelling_ends[tokens] - first
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        return self.spelling[np.arange(bounds[-1]) + np.repeat(first - bounds[:-1], sizes)], bounds

    def learn(self, words: list[bytes]) -> list[bytes]:
        """Token ids, as bytes, of words not met before, worked out all together."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        owner, flat = self.propose(data, starts, ends)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        fits = self.compatible(flat[inner].astype(np.int64) << 32 | flat[inner + 1])
        wrong = np.zeros(len(words), dtype=bool)
        wrong[owner[inner[~fits]]] = True
        counts = np.bincount(owner, minlength=len(words))
        bounds = np.concatenate([[0], np.cumsum(counts)])
        # a token alone must be what its own symbols merge to; in a pair the verdict implies it
        alone = np.flatnonzero(counts == 1)
        single = flat[bounds[alone]]
        wrong[alone[~self.reachable(single)]] = True
        raw, cuts = flat.tobytes(), (4 * bounds).tolist()
        out = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        failed = np.flatnonzero(wrong)
        if len(failed):
            symbols = self.inner[data]
            symbols[ends - 1] = self.final[data[ends - 1]]
            sizes = sizes[failed]
            to = np.concatenate([[0], np.cumsum(sizes)])
            taken = np.arange(to[-1]) + np.repeat(starts[failed] - to[:-1], sizes)
            for n, ids in zip(failed.tolist(), self.merged(symbols[taken], to)):
                out[n] = ids
        return out

    def reachable(self, tokens: np.ndarray) -> np.ndarray:
        """Whether merging a token's own symbols gives the token."""
        distinct, inverse = np.unique(tokens, return_inverse=True)
        return np.array([m == t.tobytes() for m, t in zip(self.merged(*self.spelled(distinct)), distinct)], dtype=bool)[inverse]

    def long_word(self, word: bytes) -> bytes:
        """A long word's token ids: one heap instead of a row of rounds."""
        shown = word.decode("latin-1").translate(self.alphabet)
        return np.array(self.merge(self.symbols(shown + END)), dtype=np.int32).tobytes()

    def found(self, words: list[bytes]) -> list[bytes]:
        """Token ids, as bytes, of distinct words, from memory or worked out."""
        if len(self.known) > MEMORY:
            self.known.clear()
        known = self.known
        ids = list(map(known.get, words))
        new = [k for k, i in enumerate(ids) if i is None]
        short = [k for k in new if len(words[k]) <= LONG]
        if short:
            for k, learnt in zip(short, self.learn([words[k] for k in short])):
                ids[k] = known[words[k]] = learnt
        for k in new:
            if ids[k] is None:
                ids[k] = self.long_word(words[k])
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of all texts in one array, and the n + 1 bounds of the texts in it."""
        # special tokens are cut out before a text is normalised; every second part is one
        parts = [self.specials.split(t) if self.specials else [t] for t in texts]
        plain: list[str] = []
        special: list[tuple[int, int]] = []
        for row in parts:
            for k, part in enumerate(row):
                if k % 2:
                    special.append((len(plain), self.added[part]))
                plain.append("" if k % 2 else self.normal(part))
        sizes = np.array([len(p) + 1 for p in plain], dtype=np.int64)
        joined = "\n".join(plain)
        data = np.frombuffer(joined.encode(), dtype=np.uint8)
        points = data if len(data) == len(joined) else np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        start, inside = word_starts(points)
        begins = np.flatnonzero(start)
        ids, lens, which = self.looked_up(data, points, begins, inside)
        borders = np.searchsorted(begins, np.concatenate([[0], np.cumsum(sizes)]))  # words before each part
        if special:
            which = np.insert(which, borders[[k for k, _ in special]], np.arange(len(lens), len(lens) + len(special)))
            ids = np.concatenate([ids, np.array([token for _, token in special], dtype=np.int32)])
            lens = np.concatenate([lens, np.ones(len(special), dtype=np.int64)])
            more = np.zeros(len(borders), dtype=np.int64)
            more[[k + 1 for k, _ in special]] = 1
            borders = borders + np.cumsum(more)
        first = np.cumsum(lens) - lens
        taken = lens[which]
        total = np.concatenate([[0], np.cumsum(taken)])
        at = np.arange(total[-1]) + np.repeat(first[which] - total[:-1], taken)
        rows = np.cumsum([0, *map(len, parts)])
        return ids[at], total[borders[rows]]

    def looked_up(self, data: np.ndarray, points: np.ndarray, begins: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids of the distinct words in a row, how many each has, and each word's number among them."""
        if not len(begins):
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        if data is points:
            solid, before = data[inside], np.cumsum(inside) - inside
        else:
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)  # bytes in UTF-8
            solid, before = data[np.repeat(inside, width)], np.cumsum(width * inside) - width * inside
        offsets = np.append(before[begins], len(solid)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(solid)]).dictionary_encode()
        ids = self.found(words.dictionary.to_pylist())
        lens = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        return np.frombuffer(b"".join(ids), dtype=np.int32), lens, words.indices.to_numpy(zero_copy_only=False)


@lru_cache(maxsize=2)
def encoder(source: str) -> Encoder:
    """One encoder per vocabulary and worker process: tasks share it and what it has learnt."""
    return Encoder(json.loads(source))


@lru_cache(maxsize=2)
def decoder(source: str) -> Decoder:
    return Decoder(json.loads(source))


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, source: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """The rows with a further column: the token ids of the whole text (array of int).

    ``source`` is the content of the vocabulary file (:func:`read_vocabulary`), a few MB that
    each executor gets once.  With ``decoded``, a column of that name gets the text that the
    ids decode to, in the same pass.  Columns of these names that are already there are replaced.
    """
    docs = docs.drop(ids, *([decoded] if decoded else []))
    shared = docs.sparkSession.sparkContext.broadcast(source)
    added = {ids: "array<int>", **({decoded: "string"} if decoded else {})}
    schema = docs.withColumns({name: F.lit(None).cast(kind) for name, kind in added.items()}).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(shared.value)
        for piece in pieces(batches, text):
            flat, bounds = coder.encode([t or "" for t in piece.column(piece.schema.get_field_index(text)).to_pylist()])
            values, offsets = pa.array(flat), pa.array(bounds.astype(np.int32))
            columns = [pa.ListArray.from_arrays(offsets, values)]
            if decoded:
                columns.append(coder.decode(values, offsets))
            yield pa.RecordBatch.from_arrays([*piece.columns, *columns], [*piece.schema.names, *added])

    return docs.mapInArrow(task, schema)


def decode(rows: DataFrame, source: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with a further column: the text of the token ids; null ids give an empty text."""
    rows = rows.drop(text)
    shared = rows.sparkSession.sparkContext.broadcast(source)
    schema = rows.withColumn(text, F.lit("")).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = decoder(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                column = part.column(part.schema.get_field_index(ids))
                counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*part.columns, coder.decode(column.flatten(), offsets)], [*part.schema.names, text])

    return rows.mapInArrow(task, schema)
