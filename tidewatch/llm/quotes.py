"""Chat formatting by quotation linking.

A message is parsed into stretches of lines with one quote level.  A stretch is hashed as a
whole, by paragraph, by sentence and by line, with case, white space and line wrapping made
alike, so that a quotation is found whole, in part or wrapped anew.  A quoted passage of any
level belongs to the first earlier message of its conversation that has it as own words
(level 0), or else to the first message of another conversation; passages of under FAR_WORDS
words are common talk and are not looked for elsewhere.  Each level of a message thus has an
owner: the one with most of its words.  A message answers the owner of its shallowest level
that has one; one that quotes nothing known answers the first message of its conversation.

Following answers leads to a thread's first message, by pointer doubling.  Inside a
conversation answers go to earlier turns, across conversations to smaller ids, so there are
no circles (an answer to a larger id is reported, but the message stays with its own
conversation).  A thread's messages in the order of conversation and turn, each without its
quotes, are the chat: every reply comes after what it answers.

The joins are many to one, so common passages multiply no rows; hot passages are looked up in a
broadcast of bounded size, and no conversation or thread is gathered in one task.  Null or
empty texts have no passages.  Messages without a conversation or turn are kept, answer
nothing and have no thread; messages that repeat a turn share its links.  Other columns are
not looked at, an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import dropped, looked_up, numbered_within, pieces, segment_hashes, stored

MARK = re.compile(r"[ \t]*((?:>[ \t]?)+)")
ATTRIBUTION = re.compile(r"(?:^|\s)(?:wrote|writes|said|schrieb|a écrit|escribió)[ \t]*:[ \t]*$", re.IGNORECASE)
SENTENCE_END = re.compile(r"(?<=[.!?]) ")
#: words of a passage that is looked for in other conversations
FAR_WORDS = 5

PASSAGES = "array<struct<level:int,words:int,hash:bigint>>"


def parse(text: str) -> list[tuple[int, str]]:
    """(quote level, line without marks); attribution lines just above a quote are left out."""
    lines = []
    for line in text.split("\n"):
        m = MARK.match(line)
        lines.append((m[1].count(">"), line[m.end() :]) if m else (0, line))
    out = []
    for k, (level, line) in enumerate(lines):
        below = next((x for x, _ in lines[k + 1 : k + 3] if x != level), level)
        if not (below > level and ATTRIBUTION.search(line)):
            out.append((level, line))
    return out


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def passages(lines: list[tuple[int, str]]) -> set[tuple[int, str]]:
    """(level, normalised passage): stretches of one level, whole and by paragraph, sentence and line."""
    out, own = set(), []
    for level, stretch in groupby(lines, key=lambda x: x[0]):
        texts = [normalised(line) for _, line in stretch]
        whole = " ".join(filter(None, texts))
        out.add((level, whole))
        if not level:
            own.append(whole)
        for filled, part in groupby(texts, key=bool):
            if filled:
                part = list(part)
                paragraph = " ".join(part)
                out.update((level, x) for x in (paragraph, *part, *SENTENCE_END.split(paragraph)))
    out.add((0, " ".join(filter(None, own))))  # the message without its quotes
    return {(level, x) for level, x in out if x}


def hashed(texts: list[str]) -> np.ndarray:
    """64-bit hashes of non-empty texts."""
    if not texts:
        return np.zeros(0, dtype=np.int64)
    raw = [x.encode() for x in texts]
    lengths = np.array([len(x) for x in raw], dtype=np.int64)
    return segment_hashes(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths).view(np.int64)


def parsed(rows: DataFrame, text: str) -> DataFrame:
    """The rows with further columns: own (text without quotes), n_quoted_lines, passages."""
    schema = rows.withColumns({"own": F.lit(""), "n_quoted_lines": F.lit(0), "passages": F.lit(None).cast(PASSAGES)}).schema
    kind = pa.list_(pa.struct([("level", pa.int32()), ("words", pa.int32()), ("hash", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            messages = [parse(t or "") for t in piece.column(piece.schema.get_field_index(text)).to_pylist()]
            own = ["\n".join(line for level, line in m if not level).strip() for m in messages]
            quoted = [sum(level > 0 and bool(line.strip()) for level, line in m) for m in messages]
            found = [(n, *x) for n, m in enumerate(messages) for x in sorted(passages(m))]
            columns = [pa.array([x[1] for x in found], pa.int32()), pa.array([x[2].count(" ") + 1 for x in found], pa.int32()), pa.array(hashed([x[2] for x in found]), pa.int64())]
            offsets = np.searchsorted(np.array([x[0] for x in found], dtype=np.int64), np.arange(len(messages) + 1)).astype(np.int32)
            held = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, ["level", "words", "hash"])).cast(kind)
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(own, pa.string()), pa.array(quoted, pa.int32()), held], [*piece.schema.names, "own", "n_quoted_lines", "passages"])

    return rows.mapInArrow(task, schema)


def owners(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Who has a passage as own words: (conv, hash, to_turn), the first in each conversation, and
    (hash, first, second), the first conversations that have it at all."""
    near = units.where("level = 0").groupBy("conv", "hash").agg(F.min("turn").alias("to_turn"), F.max("words").alias("words"))
    far = near.where(F.col("words") >= FAR_WORDS).select("hash", F.struct("conv", "to_turn").alias("at"))
    first = far.groupBy("hash").agg(F.min("at").alias("first"))
    second = far.join(first, "hash").where("at.conv <> first.conv").groupBy("hash").agg(F.min("at").alias("second"))
    return near.drop("words"), first.join(second, "hash", "left")


def owned_levels(units: DataFrame) -> DataFrame:
    """(conv, turn, level, to_conv, to_turn), stored: the owner of most quoted words of each level of a message."""
    near, far = owners(units)
    near, far = stored(near, "near"), stored(far, "far")
    quoted = units.where("level > 0").groupBy("conv", "turn", "level", "hash").agg(F.max("words").alias("words"))
    here = near.select(F.col("conv").alias("c"), F.col("hash").alias("h"), "to_turn")
    met = quoted.join(here, (F.col("conv") == F.col("c")) & (F.col("hash") == F.col("h")) & (F.col("to_turn") < F.col("turn")), "left").drop("c", "h")
    met = stored(met, "quoted")
    inside = met.where("to_turn is not null").select("conv", "turn", "level", "words", F.struct("conv", "to_turn").alias("there"))
    other = looked_up(met.where(F.col("to_turn").isNull() & (F.col("words") >= FAR_WORDS)).drop("to_turn"), far, "hash")
    elsewhere = F.when(F.col("first.conv") != F.col("conv"), F.col("first")).otherwise(F.col("second"))
    outside = other.select("conv", "turn", "level", "words", elsewhere.alias("there")).where("there is not null")
    votes = inside.union(outside).groupBy("conv", "turn", "level", "there").agg(F.sum("words").alias("votes"))
    rank = F.struct("votes", F.col("there.conv") == F.col("conv"), -F.col("there.conv"), F.col("there.to_turn"))
    best = votes.groupBy("conv", "turn", "level").agg(F.max_by("there", rank).alias("there"))
    levels = stored(best.select("conv", "turn", "level", F.col("there.conv").alias("to_conv"), F.col("there.to_turn").alias("to_turn")), "levels")
    dropped(near, far, met)
    return levels


def roots(nodes: DataFrame) -> DataFrame:
    """(conv, turn, root_conv, root_turn, depth) by pointer doubling over (conv, turn, up_conv, up_turn).

    A root points to itself; all others point to a smaller (conv, turn).
    """
    moves = F.struct("up_conv", "up_turn") != F.struct("conv", "turn")
    at = stored(nodes.select("conv", "turn", F.col("up_conv").alias("root_conv"), F.col("up_turn").alias("root_turn"), F.when(moves, 1).otherwise(0).alias("depth")), "threads")
    while True:
        above = at.select(F.struct("conv", "turn").alias("at"), F.struct("root_conv", "root_turn", "depth").alias("on"))
        joined = looked_up(at.withColumn("at", F.struct(F.col("root_conv").alias("conv"), F.col("root_turn").alias("turn"))), above, "at")
        moved = (F.col("on.root_conv") != F.col("root_conv")) | (F.col("on.root_turn") != F.col("root_turn"))
        before, at = at, stored(
            joined.select("conv", "turn", F.col("on.root_conv").alias("root_conv"), F.col("on.root_turn").alias("root_turn"), (F.col("depth") + F.col("on.depth")).alias("depth"), moved.alias("moved")),
            "threads",
        )
        dropped(before)
        if at.where("moved").isEmpty():
            return at.drop("moved")


def linked(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: ids, role, what it answers, its thread's first message, its depth below
    that, the owners of its quote levels (level, conv, turn), quoted lines and the text without quotes."""
    rows = messages.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    read = stored(parsed(rows, "text").drop("text"), "messages")
    placed = read.where("conv is not null and turn is not null")
    units = stored(placed.select("conv", "turn", F.explode("passages").alias("x")).select("conv", "turn", "x.level", "x.words", "x.hash"), "passages")
    levels = owned_levels(units)
    dropped(units)
    quoted = levels.groupBy("conv", "turn").agg(
        F.min_by(F.struct("to_conv", "to_turn"), "level").alias("reply"),
        F.sort_array(F.collect_list(F.struct("level", F.col("to_conv").alias("conv"), F.col("to_turn").alias("turn")))).alias("owners"),
    )
    opening = placed.groupBy("conv").agg(F.min("turn").alias("opening"))
    turns = placed.select("conv", "turn").distinct().join(opening, "conv").join(quoted, ["conv", "turn"], "left")
    answered = F.coalesce("reply", F.when(F.col("turn") > F.col("opening"), F.struct(F.col("conv").alias("to_conv"), F.col("opening").alias("to_turn"))))
    nodes = turns.withColumn("answered", answered)
    # across conversations only a smaller id is followed; else the message stays under its opening
    follows = F.col("answered.to_conv") <= F.col("conv")
    up = F.when(follows, F.col("answered")).otherwise(F.struct(F.col("conv").alias("to_conv"), F.col("opening").alias("to_turn")))
    nodes = stored(nodes.withColumn("up", up).select("conv", "turn", "answered", "owners", F.col("up.to_conv").alias("up_conv"), F.col("up.to_turn").alias("up_turn")), "nodes")
    tree = roots(nodes).join(nodes.select("conv", "turn", "answered", "owners"), ["conv", "turn"])
    links = tree.select(
        F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("answered.to_conv").alias("reply_conv"), F.col("answered.to_turn").alias("reply_turn"),
        "root_conv", "root_turn", "depth", "owners",
    )
    out = read.join(links, (F.col("conv") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
    return out.select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role), "reply_conv", "reply_turn", "root_conv", "root_turn", "depth", "owners",
        "n_quoted_lines", F.col("own").alias(text),
    )


def formatted(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The messages of :func:`linked` with their place in the thread and their turn of a chat template.

    ``place`` counts a thread's messages from 0 so that every reply comes after what it answers;
    a thread is known by root_conv and root_turn, and may be of any length.
    """
    turns = linked(messages, conv, turn, role, text)
    line = F.concat(F.lit("<|"), F.coalesce(role, F.lit("user")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n"))
    ordered = numbered_within(turns.withColumn("chat", line), ["root_conv", "root_turn"], [conv, turn, role, text], "place")
    return ordered.withColumn("place", F.when(F.col("root_conv").isNotNull(), F.col("place")))
