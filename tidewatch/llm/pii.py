"""Personal data: seed entities by rule, and bootstrapped contextual extraction of unseen ones.

Rules find e-mail addresses, IPv4 addresses, card numbers and phone numbers.  These seeds
induce lexical patterns: the two words to the left and the kind of the identifier.  Patterns
and identifier-like instances form a graph, and Spark scores it in turns: a pattern's score is
the mean over its distinct instances, where one that is known counts 1 and one that is
undecided counts half.  Patterns with enough known instances in enough texts and a high score
are trusted; all their instances become known, and support is counted anew over all patterns,
until nothing is added.  What stands in a trusted pattern is discovered wherever it occurs:
numbers and addresses that the rules miss.

Spans depend on the texts alone: a null or empty text has none, repeated rows get the same and
count once, other columns are carried along; an empty table gives an empty table.  Positions
are code points, ends are exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import TEXT_ROWS, dropped, looked_up, pieces, stored

KINDS = ("email", "ip", "card", "phone")
AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# the runs of digits are taken whole, so long runs cost no retries
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
#: what may be an identifier that the rules miss, by kind; first match wins
LIKE = (
    # only from the start of a run, so a long run costs one pass
    ("email", re.compile(r"(?<![^\s@<>()\[\]\"',;:])[^\s@<>()\[\]\"',;:]++(?:@|\[at\]|\(at\))[^\s@<>()\[\]\"',;:]++")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3,5}(?![0-9.])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+])(?:\(?[0-9]{2,4}\)?[\x20.-]){1,3}[0-9]{3,6}(?![0-9A-Za-z])")),
    ("card", re.compile(r"(?<![0-9A-Za-z])[0-9]{12,19}(?![0-9A-Za-z])")),
)
LEFT = re.compile(r"(\S+)\s+(\S+)[\s\"'(\[<]*$")
#: characters to the left that hold the context words
REACH = 80
#: known instances, and texts that they are in, of a trusted pattern; its score, and that of an undecided instance
SEEDS = 5
SCORE = 0.75
UNDECIDED = 0.5


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the seeds, by start and then kind."""
    found = []
    past = 0
    for m in AT.finditer(text) if "@" in text else ():
        start = m.start()
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            found.append((start, 0, past := m.end()))
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.groups()]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def unseen(text: str, seeds: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of identifier-like runs that touch no seed and no earlier run."""
    taken = bytearray(len(text))
    for start, _, end in seeds:
        taken[start:end] = b"\1" * (end - start)
    found = []
    for kind, shape in LIKE:
        if kind == "email" and "@" not in text and "at]" not in text and "at)" not in text:
            continue
        for m in shape.finditer(text):
            if taken.find(1, m.start(), m.end()) < 0:
                taken[m.start() : m.end()] = b"\1" * (m.end() - m.start())
                found.append((m.start(), KINDS.index(kind), m.end()))
    return sorted(found)


def context(text: str, start: int) -> str | None:
    """The two words to the left, in lower case and with digits made alike."""
    m = LEFT.search(text[max(0, start - REACH) : start])
    return re.sub(r"[0-9]", "0", f"{m[1]} {m[2]}".lower()) if m else None


def occurrences(texts: DataFrame) -> DataFrame:
    """Identifiers and what may be some: text key, place, kind, pattern, instance, is_seed."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            rows = []
            for key, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                if not text:
                    continue
                seeds = base_spans(text)
                for spans, seed in ((seeds, True), (unseen(text, seeds), False)):
                    for start, kind, end in spans:
                        if (left := context(text, start)) is not None:
                            rows.append((key, start, end, kind, f"{KINDS[kind]}: {left}", text[start:end], seed))
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "start", "end", "kind", "pattern", "instance", "seed"])

    return texts.mapInArrow(task, "key long, start long, end long, kind int, pattern string, instance string, seed boolean")


def trusted_patterns(edges: DataFrame, seeds: int = SEEDS, score: float = SCORE) -> DataFrame:
    """(pattern): those trusted at the end of the bootstrap over edges (pattern, item, seed, some_key).

    Edges are distinct; patterns that could not be trusted if all their instances were known are
    left out first.  Known instances only grow, so the turns come to an end.
    """
    able = edges.groupBy("pattern").agg(F.count("*").alias("n"), F.countDistinct("some_key").alias("texts"))
    able = able.where((F.col("n") >= seeds) & (F.col("texts") >= seeds)).select("pattern", F.lit(True).alias("able"))
    edges = stored(looked_up(edges, able, "pattern").where("able").drop("able"), "edges")
    known = stored(edges.where("seed").select("item").distinct(), "known")
    n = known.count()
    while True:
        marked = looked_up(edges, known.withColumn("ok", F.lit(True)), "item")
        worth = (F.count("ok") + UNDECIDED * (F.count("*") - F.count("ok"))) / F.count("*")
        scored = marked.groupBy("pattern").agg(F.count("ok").alias("support"), F.countDistinct(F.when(F.col("ok"), F.col("some_key"))).alias("texts"), worth.alias("worth"))
        good = (F.col("support") >= seeds) & (F.col("texts") >= seeds) & (F.col("worth") >= score)
        trusted = stored(scored.where(good).select("pattern", F.lit(True).alias("trusted")), "patterns")
        grown = stored(known.union(looked_up(edges, trusted, "pattern").where("trusted").select("item")).distinct(), "known")
        dropped(known)
        known, before, n = grown, n, grown.count()
        if n == before:
            dropped(edges, known)
            return trusted
        dropped(trusted)


def discovered(docs: DataFrame, text: str = "text", seeds: int = SEEDS, score: float = SCORE) -> DataFrame:
    """(key, more): the spans that patterns add to a text, as an array of (start, kind, end).

    The key is the text's hash; texts without a discovery have no row.
    """
    texts = docs.select(F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    found = stored(occurrences(texts), "occurrences", TEXT_ROWS)
    # distinct pairs with a hash of the instance: the graph's edges
    edges = found.groupBy("pattern", F.xxhash64("instance", "kind").alias("item")).agg(F.max("seed").alias("seed"), F.min("key").alias("some_key"))
    edges = stored(edges, "pairs")
    trusted = trusted_patterns(edges, seeds, score)
    spans = looked_up(found.where("not seed"), trusted, "pattern").where("trusted")
    more = stored(spans.groupBy("key").agg(F.collect_set(F.struct("start", "kind", "end")).alias("more")), "discovered")
    dropped(found, edges, trusted)
    return more


#: names of two columns while texts are joined with what patterns add to them
KEY, MORE = "__pii_key", "__pii_more"
SPANS = "array<struct<start:bigint,kind:string,end:bigint,found:string>>"


def spans_of(text: str | None, more: list[dict] | None) -> list[dict]:
    """All spans of a text by start and then kind; ``found`` tells rule from pattern."""
    spans = [(s, k, e, "rule") for s, k, e in base_spans(text or "")]
    spans += [(x["start"], x["kind"], x["end"], "pattern") for x in more or []]
    return [{"start": s, "kind": KINDS[k], "end": e, "found": f} for s, k, e, f in sorted(spans)]


def with_discovered(docs: DataFrame, text: str) -> DataFrame:
    """The rows and, last, what patterns add to their texts."""
    extra = discovered(docs, text).select(F.col("key").alias(KEY), F.col("more").alias(MORE))
    return docs.join(extra, F.xxhash64(docs[text]) == extra[KEY], "left").select(*[docs[f"`{c}`"] for c in docs.columns], extra[MORE])


def read_spans(piece: pa.RecordBatch, text: str) -> tuple[list[str | None], list[list[dict]]]:
    """The texts of a piece of :func:`with_discovered`, and all spans of each."""
    texts, more = (piece.column(k).to_pylist() for k in (piece.schema.get_field_index(text), piece.num_columns - 1))
    return texts, [spans_of(t, m) for t, m in zip(texts, more)]


def with_spans(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """The rows with a further column: all spans of personal data in the whole text."""
    docs = docs.drop(spans)
    names = docs.columns
    schema = docs.withColumn(spans, F.lit(None).cast(SPANS)).schema
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("found", pa.string())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            found = pa.array(read_spans(piece, text)[1], kind)
            yield pa.RecordBatch.from_arrays([*piece.columns[: len(names)], found], [*names, spans])

    return with_discovered(docs, text).mapInArrow(task, schema)


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents with each span replaced by its kind in angle brackets, e.g. <EMAIL>.

    Spans that overlap are replaced together, by the first one's kind.  A column of the name
    ``length`` gets the new number of characters.
    """
    names, schema = docs.columns, docs.schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            texts = pa.array([replaced(t, s) for t, s in zip(*read_spans(piece, text))], pa.string())
            yield pa.RecordBatch.from_arrays([texts if n == text else piece.column(k) for k, n in enumerate(names)], names)

    out = with_discovered(docs, text).mapInArrow(task, schema)
    if length in names:
        out = out.withColumn(length, F.when(F.col(text).isNotNull(), F.length(text)).otherwise(F.col(length)).cast(schema[length].dataType))
    return out


def replaced(text: str | None, spans: list[dict]) -> str | None:
    if not text or not spans:
        return text
    parts, past = [], 0
    for span in spans:
        if span["start"] >= past:
            parts += [text[past : span["start"]], f"<{span['kind'].upper()}>"]
        past = max(past, span["end"])
    return "".join([*parts, text[past:]])
