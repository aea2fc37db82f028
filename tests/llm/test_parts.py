"""The operators' parts against plain second opinions, without Spark."""

from __future__ import annotations

import json
import random
import time
import re

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import bpe, html_text, langid, lm, minhash, mixing, pii, quality, quotes
from tidewatch.llm.common import find_words, segment_hashes, text_bytes
from tidewatch.llm.gru import Gru

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t", "a", "Äb  c\x0bd\n", "one two three four five " * 40, "x" * 70_000, "é ü\x85ß end", "ab ab\nab ab\n\nab ab\nz", "a b c d e a b c d e f"]


def test_words_and_hashes():
    data, offsets = text_bytes(pa.array(TEXTS))
    starts, lengths, bounds = find_words(data, offsets)
    words = [bytes(data[s : s + n]).decode() for s, n in zip(starts, lengths)]
    got = [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    assert got == [WORD.findall(t or "") for t in TEXTS]
    hashes = segment_hashes(data, starts, lengths)
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


def test_quality_measures():
    data, offsets = text_bytes(pa.array(TEXTS))
    got = quality.measures(data, offsets, [t or "" for t in TEXTS])
    for k, text in enumerate(t or "" for t in TEXTS):
        words = WORD.findall(text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        repeated = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert tuple(int(got[c][k]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want


def test_threshold_splits_two_groups():
    scores, good = np.array([-3.0, -2.0, 0.1, 0.2, 0.3]), np.array([False, False, True, True, True])
    assert -2.0 < quality.place_threshold(scores, good) < 0.1
    assert quality.place_threshold(scores, np.ones(5, dtype=bool)) == -np.inf


def test_set_sketch_estimates_and_merges():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for shared in (300, 600, 900):
        a, b = np.unique(pool[:1000]), np.unique(np.concatenate([pool[:shared], pool[1000 : 2000 - shared]]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        rows = minhash.registers([a, b, np.union1d(a, b)])
        assert (minhash.merge_registers(rows[0], rows[1]) == rows[2]).all()
        up, down = (rows[0] > rows[1]).sum(), (rows[0] < rows[1]).sum()
        near = minhash.likely_similarity(np.array([up]), np.array([down]), np.array([float(len(a))]), np.array([float(len(b))]))[0]
        assert abs(near - true) < 0.15


def test_recurrent_gradients():
    rng = np.random.default_rng(0)
    layer = Gru(5, 3, rng)
    layer.w, layer.u = layer.w.astype(float), layer.u.astype(float)
    ids, h, keep = rng.integers(0, 5, (6, 4)), np.zeros((3, 4)), rng.integers(0, 2, (6, 4))
    goal = rng.standard_normal((6, 3, 4))
    states, memory = layer.run(ids, h, keep)
    for p, grad in zip((layer.w, layer.u), layer.back(ids, memory, states - goal, keep)):
        for at in [(0, 0), (2, 1), (5, 2), (8, 1)]:
            old = p[at]
            losses = []
            for step in (1e-6, -1e-6):
                p[at] = old + step
                losses.append(((layer.run(ids, h, keep)[0] - goal) ** 2).sum() / 2)
            p[at] = old
            assert abs((losses[0] - losses[1]) / 2e-6 - grad[at]) < 1e-6


def test_windows_carry_the_state_and_probabilities_sum_to_one():
    model = lm.Model(np.sort(np.random.default_rng(1).integers(0, lm.HEAD_CLASSES, 40)))
    rows = [np.random.default_rng(k).integers(0, 40 + lm.TAIL_CLASSES, n) for k, n in enumerate((0, 3, 200, 65, 64))]
    bounds = np.cumsum([0, *map(len, rows)])
    got = model.totals(np.concatenate(rows), bounds)
    for row, total in zip(rows, got):
        h, want = np.zeros((lm.HIDDEN, 1), dtype=np.float32), 0.0
        for before, token in zip([model.end, *row], [*row, model.end]):
            h = model.layer.step(np.array([before]), h)
            want += float(model.log_probabilities(h, np.array([token]))[0])
        assert total == pytest.approx(want, rel=1e-4)
    every = np.arange(model.end + 1)
    h = np.repeat(np.random.default_rng(2).standard_normal((lm.HIDDEN, 1)).astype(np.float32), len(every), axis=1)
    used = np.isin(model.class_of(every), np.concatenate([np.unique(model.head_class), np.arange(lm.HEAD_CLASSES, model.end_class + 1)]))
    logits = model.classes @ h[:, :1]
    empty = np.setdiff1d(np.arange(lm.HEAD_CLASSES), model.head_class)
    share = np.exp(logits[empty]).sum() / np.exp(logits).sum()  # classes without a word
    assert used.all() and np.exp(model.log_probabilities(h, every)).sum() == pytest.approx(1 - share, abs=1e-4)


def test_spans_match_plain_patterns():
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    rng = random.Random(5)
    texts = ["".join(rng.choices("ab1234567890.@-+ ()%", weights=[2, 2, *[2] * 10, 4, 2, 2, 2, 3, 1, 1, 1], k=rng.randint(0, 60))) for _ in range(4000)]
    texts += ["a@b.c@d.e", "@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.3.4", "4111 1111 1111 1111", "+1 (555) 123-4567"]
    for text in texts:
        want = []
        for k, (kind, pattern) in enumerate(plain.items()):
            for m in re.finditer(pattern, text):
                digits = re.sub(r"\D", "", m.group())
                if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                    continue
                if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                    continue
                if kind == "phone" and not 9 <= len(digits) <= 15:
                    continue
                want.append((m.start(), k, m.end()))
        assert pii.base_spans(text) == sorted(want), text


def test_spans_of_long_runs_take_no_retries():
    assert pii.base_spans("1" * 200_000 + "." + "a" * 200_000 + "." * 50_000) == []
    # long runs and many candidates cost one pass each
    text = "a" * 1_000_000 + " b@c x [at] foo[at]bar.com " + "123 4567 " * 50_000
    assert len(pii.unseen(text, pii.base_spans(text))) == 2 + 25_000


def test_replaced():
    assert pii.replaced("x a@b.co y", pii.spans_of("x a@b.co y", None)) == "x <EMAIL> y"
    assert pii.replaced(None, []) is None


@pytest.mark.parametrize("text", ["", "It's THE don't I'LL", "<|endoftext|>a b<|startoftext|>", "ΣΑΣ é ﬁ 日本 한 ½ ²  \x85 x́", "a" * 3000, "ab" * 700, "!!!??? $$$ 123 4.5", "İI"])
def test_tokens_match_the_library(text):
    from tokenizers import Tokenizer

    path = "/opt/tokenizers/word_bpe_49k.json"
    coder, library = encoder(path), Tokenizer.from_file(path)
    ids = library.encode(text, add_special_tokens=False).ids
    assert encoded(coder, ["x", text, "", text]) == [library.encode("x", add_special_tokens=False).ids, ids, [], ids]
    assert coder.decode(pa.array(ids, pa.int32()), pa.array([0, len(ids)], pa.int32())).to_pylist() == [library.decode(ids, skip_special_tokens=False)]


def test_tokens_of_random_texts_match_the_library():
    from tokenizers import Tokenizer

    path = "/opt/tokenizers/word_bpe_49k.json"
    coder, library, rng = encoder(path), Tokenizer.from_file(path), random.Random(9)
    letters = [*"''" "''stmdrevlLSDaZ 09!?-\n\t\u00a0\u2028", "é", "e\u0301", "ß", "日", "½", "²", "Ⅷ", "٣", "😀", "\u200d", "Σ", "ς", "<|endoftext|>", "\u180e", "\x1c"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(3000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoded(coder, texts) == want
    plain = [t for t in texts if t.isascii()]
    assert encoded(coder, plain) == [w for t, w in zip(texts, want) if t.isascii()]


def encoded(coder: bpe.Encoder, texts: list[str]) -> list[list[int]]:
    ids, bounds = coder.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def encoder(path: str, made: dict = {}) -> bpe.Encoder:  # noqa: B006
    if path not in made:
        made[path] = bpe.encoder(bpe.read_vocabulary(path))
    return made[path]


def test_tokens_of_random_words_match_exact_merging():
    coder, rng = encoder("/opt/tokenizers/word_bpe_49k.json"), random.Random(2)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 25))) for _ in range(1500)]
    for word, ids in zip(words, encoded(coder, words)):
        assert ids == coder.merge(coder.symbols(word + bpe.END))


def test_a_piece_may_have_more_words_than_are_remembered(monkeypatch):
    coder = bpe.Encoder(json.loads(bpe.read_vocabulary("/opt/tokenizers/word_bpe_49k.json")))
    text = " ".join(f"word{k} number" for k in range(40))
    want = encoded(coder, [text, "word7 of"])
    monkeypatch.setattr(bpe, "MEMORY", 3)
    for _ in range(2):
        assert encoded(coder, [text, "word7 of"]) == want


def test_walk_keeps_words_and_leaves_one_open():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 500):
        words, share = rng.integers(1, 900, n).astype(float), np.full(n, rng.random())
        out = mixing.walk(words, share, rng.random(n))
        assert ((out > 0) & (out < 1)).sum() <= 1
        assert (out * words).sum() == pytest.approx((share * words).sum())
    mean = np.mean([mixing.walk(np.array([5.0, 3, 2, 9]), np.full(4, 0.4), rng.random(4)) for _ in range(8000)], axis=0)
    assert np.abs(mean - 0.4).max() < 0.03


def test_main_text():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><div class='ad'>Buy</div><article><h1>A &amp; B</h1>"
        "<p><b>One\n two.<br>three<p>Short.</p><script>var t='</p>'</script><div class='comments'><p>Nice!</div></article><aside>x</aside><footer>&copy; y</footer>"
    )
    assert html_text.main_text(page) == "A & B\nOne two. three\nShort."
    loose = "<div class=menu><a>a</a><a>b</a></div><div><p>" + "A long paragraph of words. " * 5 + "<p>End.</div><div><a>x</a> <a>y</a></div>"
    assert html_text.main_text(loose).endswith("\nEnd.") and "x y" not in html_text.main_text(loose)
    assert html_text.main_text("<p>") == "" and html_text.main_text("plain") == "plain"


def test_main_text_clusters_every_page():
    long = ["A long paragraph of the real text, with many words in it. " * 6 + str(k) for k in range(4)]
    teaser = "<article class=card><a href=x>Read this too</a></article>"
    real = "<div class=story>" + "".join(f"<p>{x}</p>" for x in long) + "<p>End.</p></div>"
    want = "\n".join([*long, "End."])
    assert html_text.main_text(f"<body>{teaser}{real}</body>") == want
    assert html_text.main_text(f"<body>{teaser * 3}{real.replace('div', 'article')}</body>") == want
    assert html_text.main_text(f"<body><main>{teaser}<div>{real.replace('div', 'article')}</div></main></body>") == want
    whole = "<article><h1>Title</h1><div><p>Lead.</p></div><div>" + real + "</div></article>"
    assert html_text.main_text(whole) == "Title\nLead.\n" + want


def test_main_text_of_split_and_wrapped_articles():
    long = ["A long paragraph of the real text, with many words in it. " * (6 + k) + str(k) for k in range(4)]
    want, links = "\n".join(long), "<a href=x>Home</a> <a href=y>News</a>"
    for tag in ("div", "section", "td"):
        parts = "".join(f"<{tag}><p>{x}</p></{tag}>" for x in long)
        body = f"<table><tr><td>{links}</td>{parts}</tr></table>" if tag == "td" else f"<div>{links}</div>{parts}"
        assert html_text.main_text(f"<body>{body}</body>") == want
    uneven = f"<div><p>{want * 9}</p></div><div><p>{long[0]}</p></div>"
    assert html_text.main_text(uneven) == want.replace("\n", " ") * 9 + "\n" + long[0]
    story = "".join(f"<p>{x}</p>" for x in long)
    for wrapper in ("class='with-sidebar'", "class='has-header'", "id='search-results'"):
        for inner in ("div", "article"):
            page = f"<div {wrapper}><{inner}>{story}</{inner}><div class=sidebar>Buy this</div></div><div class=notice>Old site.</div>"
            assert html_text.main_text(page) == want
    assert html_text.main_text("<div class=notice>A notice, longer than the text of its page.</div><article><p>Short but whole.</article>") == "Short but whole."


def test_main_text_of_forms_headers_and_anchors():
    text = "A long paragraph of the real text, with many words in it. " * 6
    want = f"{text.strip()}\nEnd of it."
    story = f"<div class=story><p>{text}</p><p>End of it.</p></div>"
    assert html_text.main_text(f"<body><form id=aspnetForm><input name=x><select><option>one</select>{story}</form></body>") == want
    assert html_text.main_text(f"<body><header><h1></h1>{story}</body>") == want
    assert html_text.main_text(f"<body><header><a href=x>Site</a> by us</header>{story}<form>Your name <input></form></body>") == want
    inner = f"<article><p>{text}</p><section id='search'><p>{text}</p></section><div id='comments'><p>Nice! {text}</p></div><div class='share'>Tell others</div></article>"
    assert html_text.main_text(f"<body>{inner}</body>") == f"{text.strip()}\n{text.strip()}"


def test_html_of_stray_and_open_tags_takes_linear_time():
    def seconds(n):
        started = time.process_time()
        for page in ("<div>" * n + "</section>" * n, "<b><div>" + "<i>" * n + "</b>" * n, "<b>" * n + "<h1>" * n + "x", "<li>" * n + "</ul>" * n, "<p><span>" * n):
            html_text.main_text(page)
        return time.process_time() - started

    seconds(1000)
    assert seconds(16_000) < 16 * seconds(2_000) + 1


def test_quote_levels():
    text = "On Monday Ann wrote:\n> > deep\n> shallow\n\nMy answer."
    assert quotes.parse(text) == [(2, "deep"), (1, "shallow"), (0, ""), (0, "My answer.")]


def test_language_windows_cover_whole_texts():
    reader = langid.Reader(["a", "b", "c"])
    data, offsets = text_bytes(pa.array(["x" * 64, "", "yz" * 50, "q"]))
    p = reader.probabilities(data, offsets)
    assert p.sum(axis=1) == pytest.approx([1, 0, 1, 1], abs=1e-4)
