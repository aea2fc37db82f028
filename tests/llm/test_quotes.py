"""Quotation linking against a plain search, on rows with every kind of quotation."""

from __future__ import annotations

import random
import re

from conftest import SMALL
from tidewatch.llm import queries, quotes

SCHEMA = "conv_id long, turn long, role string, text string, root_turn string, place int, chat int"
ANN = "The tide comes in twice a day here. It reaches the old wall at noon.\n\nBring boots and a lamp for the way back."
BEN = "We could meet at the harbour steps instead.\nThe wall is slippery when it rains, as it did last week."
COMMON = "Yes, that sounds good to me as well."


def quote(text, level=1):
    return "\n".join("> " * level + line for line in text.split("\n"))


ROWS = [
    (1, 0, "user", ANN), (1, 1, "assistant", f"Ann wrote:\n{quote(ANN)}\n{BEN}"), (1, 2, "user", quote(ANN, 2) + "\n" + quote(BEN) + "\n" + COMMON),
    # nested text only; a quotation wrapped anew; a sentence; a line that everyone says
    (1, 3, "assistant", quote(BEN, 2) + "\nAgreed then."), (1, 4, "user", "> we could meet at the\n> HARBOUR steps instead. The wall is slippery\n> when it rains, as it did last week.\nFine."),
    (1, 5, "assistant", "> It reaches the old wall at noon.\nAt noon sharp?"), (1, 6, "user", "> Yes.\nYes."),
    (2, 0, "user", f"{quote(BEN)}\nI read this elsewhere, is it so?"), (2, 1, "assistant", None), (2, 2, "user", "> Yes.\nWell."), (2, 3, "user", COMMON),
    # the first message that says it is a later turn of the same conversation: the other owner counts
    (0, 5, "user", quote(COMMON) + "\nGlad to hear."), (0, 6, "user", COMMON), (0, 7, "user", quote(COMMON) + "\nMe too."),
    (3, None, "user", ""), (None, 0, None, quote(ANN)), (3, 2, "", "x"), (3, 2, "user", quote("x")), (3, 1, None, "y"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "q", 1, 2) for r in rows], SCHEMA)


def brute(rows):
    """Links and threads by search over all pairs of messages, from the module's rules."""
    owned, asked = {}, {}
    for c, t, _, text in rows:
        if c is not None and t is not None:
            for level, p in quotes.passages(quotes.parse(text or "")):
                if level:
                    asked.setdefault((c, t), set()).add((level, p))
                else:
                    owned.setdefault(p, {}).setdefault(c, set()).add(t)
    owned = {p: {c: min(ts) for c, ts in held.items()} for p, held in owned.items()}
    at = {(c, t) for c, t, *_ in rows if c is not None and t is not None}
    reply, up, levels = {}, {}, {}
    for c, t in at:
        votes = {}
        for level, p in asked.get((c, t), ()):
            held = owned.get(p, {})
            if c in held and held[c] < t:
                owner = (c, held[c])
            elif len(p.split(" ")) >= quotes.FAR_WORDS and set(held) - {c}:
                other = min(set(held) - {c})
                owner = (other, held[other])
            else:
                continue
            by = votes.setdefault(level, {})
            by[owner] = by.get(owner, 0) + len(p.split(" "))
        best = {level: max(by, key=lambda o: (by[o], o[0] == c, -o[0], o[1])) for level, by in votes.items()}
        opening = (c, min(x for d, x in at if d == c))
        reply[c, t] = best[min(best)] if best else opening if (c, t) != opening else None
        levels[c, t] = [(level, *best[level]) for level in sorted(best)]
        up[c, t] = opening if reply[c, t] is None or reply[c, t][0] > c else reply[c, t]
    root = {}
    for m in at:
        x, d = m, 0
        while up[x] != x:
            x, d = up[x], d + 1
        root[m] = (*x, d)
    return {m: (reply[m], root[m], levels[m]) for m in at}


def check(spark, rows):
    want = brute(rows)
    got = quotes.formatted(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    threads = {}
    for r in got:
        m = (r["conv_id"], r["turn"])
        if None in m:
            assert r["reply_conv"] is r["root_conv"] is r["place"] is r["depth"] is None
            continue
        reply, root, levels = want[m]
        assert (r["reply_conv"], r["reply_turn"]) == (reply or (None, None)), m
        assert (r["root_conv"], r["root_turn"], r["depth"]) == root and [tuple(x) for x in r["owners"] or []] == levels, m
        threads.setdefault(root[:2], []).append((r["place"], m, reply))
    for root, members in threads.items():
        members.sort()
        assert [p for p, *_ in members] == list(range(len(members))) and members[0][1] == root
        place = {}
        for p, m, _ in members:
            place.setdefault(m, p)
        for p, m, reply in members:  # a reply comes after what it answers
            assert reply not in place or place[reply] < p or reply[0] > m[0]
    return {(r["conv_id"], r["turn"]): r for r in got}


def test_every_kind_of_quotation(spark):
    got = check(spark, ROWS)
    reply = {m: (r["reply_conv"], r["reply_turn"]) for m, r in got.items()}
    assert reply[1, 1] == (1, 0) and reply[1, 2] == (1, 1) and [tuple(x) for x in got[1, 2]["owners"]] == [(1, 1, 1), (2, 1, 0)]
    assert reply[1, 3] == (1, 1) and reply[1, 4] == (1, 1) and reply[1, 5] == (1, 0)
    assert reply[1, 6] == (1, 0) and reply[2, 2] == (2, 0)  # common talk links to nothing, so to the opening
    assert reply[2, 0] == (1, 1) and (got[2, 1]["root_conv"], got[2, 1]["depth"]) == (1, 3)
    assert reply[0, 5] == (1, 2) and reply[0, 7] == (0, 6) and got[0, 5]["root_conv"] == 0
    assert got[1, 1]["text"] == BEN and got[1, 1]["n_quoted_lines"] == 2 and got[1, 3]["chat"] == "<|assistant|>\nAgreed then.\n"


def test_random_threads(spark):
    rng = random.Random(5)
    lines = [" ".join(rng.choices("oak elm ash fir yew box may sun".split(), k=rng.randint(1, 8))) + rng.choice([".", ""]) for _ in range(40)]
    rows, texts = [], []
    for c in range(12):
        for t in range(rng.randint(1, 7)):
            parts = []
            for _ in range(rng.randint(0, 2)):
                if texts:
                    parts.append(quote("\n".join(rng.choice(texts).split("\n")[: rng.randint(1, 3)]), rng.randint(1, 2)))
            parts.append("\n".join(rng.choices([*lines, ""], k=rng.randint(1, 4))))
            texts.append(parts[-1])
            rows.append((c, t, rng.choice(["user", "assistant"]), "\n".join(parts)))
    rng.shuffle(rows)
    got = check(spark, rows)
    assert sum(bool(r["owners"]) for r in got.values()) > 10


def test_empty_table_and_given_table(spark):
    assert quotes.formatted(frame(spark, [])).collect() == []
    got = queries.op5_quotes(spark, SMALL)
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    assert got.count() == table.count() and not any(re.search("(?m)^> ", r["chat"]) for r in got.collect())
