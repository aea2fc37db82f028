"""Every operator on odd rows and on empty tables, and on sample tables against brute force."""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from tidewatch.llm import bpe, embeddings, html_text, langid, lm, minhash, mixing, pii, quality, queries
from tidewatch.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, size string, spans string, label int, kept string, row string"
LONG = " ".join(f"w{k}" for k in range(3000))
BASE = " ".join(f"word{k}" for k in range(60))
ROWS = [
    (1, BASE, "en", "s1"), (2, BASE, "en", "s1"), (3, BASE + " tail", None, "s2"), (3, BASE + " tail", None, "s2"), (None, BASE, "en", None),
    (5, None, None, None), (6, "", "de", "s2"), (7, " \n", "de", "s2"), (8, LONG, "en", "s1"), (9, "one two", "fr", ""), (10, "mail me: bob@site.example.org now", "en", "s1"),
]
VOCABULARY = bpe.read_vocabulary("/opt/tokenizers/word_bpe_49k.json")


@pytest.fixture(scope="module", params=["odd", "empty"])
def docs(request, spark):
    rows = ROWS if request.param == "odd" else []
    return spark.createDataFrame([(*r, len(r[1] or ""), 1, "x", "y", 0, "z", "q") for r in rows], SCHEMA)


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 9), (9, 8), (20, 21), (7, 7), (None, 1), (5, 4)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 8: 3, 9: 3, 20: 20, 21: 20}


def test_components_of_hubs(spark):
    """Stars far above the hub limit, joined by a path, and a second graph beside them."""
    links = [(0, k) for k in range(1, 1500)] + [(5000 + k, 4999) for k in range(1500)] + [(1499, 5200), (9001, 9000), (9002, 9001)]
    rows = components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()
    got = {r["node"]: r["label"] for r in rows}
    assert len(rows) == len(got) == 1500 + 1501 + 3
    assert {got[k] for k in range(1500)} | {got[4999 + k] for k in range(1501)} == {0} and {got[k] for k in (9000, 9001, 9002)} == {9000}


def test_near_duplicates(docs):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs, size=4).collect()}
    assert len(got) == len({r["doc_id"] for r in docs.collect()})
    if got:
        assert [got[k]["component_id"] for k in (1, 2, 3, 5, 6, 7, 8, 9)] == [1, 1, 1, 5, 6, 7, 8, 9]
        assert got[None]["component_id"] is None and got[5]["n_shingles"] == 0 and got[9]["n_shingles"] == 1
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == ([1, 5, 6, 7, 8, 9, 10, None] if got else [])


def test_near_duplicates_against_all_pairs(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    sets = {}
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[r["doc_id"]] = {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    label = {k: k for k in sets}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while any(label[a] != label[b] for a, b in links):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = minhash.near_duplicates(spark.read.parquet(f"{SMALL}/documents.parquet"), size=4).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {k: (len(s), label[k], label[k] == k) for k, s in sets.items()}


def test_language(docs):
    got = langid.predict(docs, langid.fit(docs, per_language=5)).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) and 0 <= r["score"] <= 1


def test_texts_without_a_letter(spark):
    rows = spark.createDataFrame([(1, "½ ² ① Ⅷ 12 !"), (2, "é"), (3, "日本"), (4, "² x"), (5, "٣٤")], "doc_id long, text string")
    learnt = langid.fit(spark.read.parquet(f"{SMALL}/documents.parquet"), per_language=5)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(rows, learnt).collect()}
    assert got[1] == got[5] == "und" and "und" not in (got[2], got[3], got[4])


def test_language_held_out(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    got = langid.predict(rows, langid.fit(rows, per_language=150)).where(held).select((F.col("lang") == F.col("lang_pred")).cast("int").alias("right"))
    assert got.agg(F.avg("right")).first()[0] > 0.97


def test_main_text_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "<p>a<p>b", "x"), (3, "u", "<p>a<p>b", "x")], "page_id long, url string, html string, text string")
    assert [r["text"] for r in html_text.extract(pages).orderBy("page_id").collect()] == ["", "", "a\nb", "a\nb"]
    assert html_text.extract(pages.limit(0)).collect() == []


def test_lm_score(docs):
    got = lm.score(docs, lm.fit(lm.learning(docs))).collect()
    assert len(got) == docs.count()
    for r in got:
        assert np.isfinite(r["score"]) and r["n_tokens"] >= r["n_known"] >= 0


def test_lm_joins_rare_words(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet")
    whole = lm.fit(lm.learning(rows))
    few = lm.Fitted(lm.vocabulary(whole.counts, whole.words.ends, frequent=5 * lm.HEAD), whole.model, whole.counts)
    # the limit is an upper bound: the head has to fit in it, and words have to be left for the join
    assert len(few.words.head_class) == lm.HEAD and lm.HEAD < len(few.words.frequent) < len(whole.words.frequent)
    a, b = ({r["doc_id"]: r for r in lm.score(rows, f).collect()} for f in (whole, few))
    assert sum(r["score"] > r["base_score"] for r in a.values()) > 0.9 * len(a)
    for k in a:
        assert a[k]["n_known"] == b[k]["n_known"] and a[k]["base_score"] == pytest.approx(b[k]["base_score"]) and a[k]["score"] == pytest.approx(b[k]["score"], rel=1e-5)


def test_personal_data(docs):
    got = pii.with_spans(docs).collect()
    assert [s["kind"] for r in got for s in r["spans"]] == (["email"] if got else [])
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert {r["doc_id"]: r["text"] for r in out.collect()}.get(10, "mail me: <EMAIL> now") == "mail me: <EMAIL> now"


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(k, f"please write to contact address: user{k}@host{k}.example.com today") for k in range(20)]
    rows += [(100, "please write to contact address: root@localhost today"), (101, "odd thing: root@localhost today")]
    got = {r["doc_id"]: r["spans"] for r in pii.with_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s["kind"], s["found"]) for s in got[100]] == [("email", "pattern")] and got[101] == []


def test_bootstrap_grows_until_nothing_is_added(spark):
    """Known numbers trust a context, its unseen numbers trust the next context, which knows none by rule."""
    rows = [(k, f"you can call me at +1 555 000 {1000 + k} any time") for k in range(8)]
    rows += [(20 + k, f"you can call me at 555-{2000 + k} any time") for k in range(6)]  # 43 % unseen
    rows += [(40 + k, f"or ring office number 555-{2000 + k} please") for k in range(6)]  # no rule finds one here
    rows += [(50, "or ring office number 555-9999 please"), (60, "the part is 555-3333 big"), (61, "only once at +1 555 000 4444")]
    rows += [(70 + k, f"order number was 777-{3000 + k} then") for k in range(30)] + [(110 + k, f"order number was +1 555 777 {3000 + k} then") for k in range(6)]
    rows += rows[:3] + [(200, None), (201, "")]
    got = {r["doc_id"]: [(s["kind"], s["found"]) for s in r["spans"]] for r in pii.with_spans(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, more int")).collect()}
    assert got[0] == [("phone", "rule")] and got[20] == got[40] == got[50] == [("phone", "pattern")]
    assert got[60] == got[70] == got[200] == got[201] == [] and got[110] == [("phone", "rule")]


def plain_trust(edges, seeds, score):
    known = {i for _, i, seed, _ in edges if seed}
    while True:
        trusted = set()
        for p in {e[0] for e in edges}:
            mine = [e for e in edges if e[0] == p]
            ok = [e for e in mine if e[1] in known]
            if len(ok) >= seeds and len({e[3] for e in ok}) >= seeds and (len(ok) + 0.5 * (len(mine) - len(ok))) / len(mine) >= score:
                trusted.add(p)
        more = known | {e[1] for e in edges if e[0] in trusted}
        if more == known:
            return trusted
        known = more


def test_bootstrap_against_a_plain_walk(spark):
    rng = np.random.default_rng(3)
    pairs = {(int(rng.integers(40)), int(rng.integers(150))) for _ in range(600)}
    edges = [(f"p{p}", i, i % 4 == 0, int(rng.integers(60))) for p, i in sorted(pairs)]
    table = spark.createDataFrame(edges, "pattern string, item long, seed boolean, some_key long")
    for seeds, score in ((3, 0.6), (4, 0.65), (5, 0.75)):
        got = {r["pattern"] for r in pii.trusted_patterns(table, seeds, score).collect()}
        assert got == plain_trust(edges, seeds, score)
    assert pii.trusted_patterns(table.limit(0)).collect() == []


def test_mixture(docs):
    got = mixing.mixture(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] + 1e-6
    assert mixing.mixed(docs).columns == docs.columns


def test_mixture_targets(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mixture(rows).join(rows.select("doc_id", "source"), "doc_id").toPandas()
    again = mixing.mixture(rows.repartition(7)).toPandas()
    assert got.set_index("doc_id").taken.sort_index().equals(again.set_index("doc_id").taken.sort_index())
    size, largest = got.groupby("source")["size"].sum(), got.groupby("source")["size"].max()
    names = sorted(size.index, key=lambda s: s.encode())
    goal, capped = {}, set()
    while True:
        weights = {n: mixing.WEIGHTS[k % 3] for k, n in enumerate(names) if n not in capped}
        left = 1.5 * size.sum() - sum(2 * size[n] for n in capped)
        goal = {n: left * w / sum(weights.values()) for n, w in weights.items()} | {n: 2.0 * size[n] for n in capped}
        over = {n for n in weights if goal[n] > 2 * size[n]}
        if not over:
            break
        capped |= over
    for n in names:
        part = got[got.source == n]
        assert part.target.iloc[0] == pytest.approx(goal[n]) and abs(part.taken.sum() - goal[n]) <= largest[n]


def test_quality(docs, spark):
    labels = docs.where("doc_id is not null").select("doc_id", F.lit(1).alias("quality"))
    ratio = quality.fit(docs, labels)
    got = quality.quality_report(docs, ratio).collect()
    assert len(got) == docs.count() and all(r["base_failed"] == (r["n_words"] < 10) for r in got)
    assert quality.keep_good(docs, ratio).columns == docs.columns


def test_quality_follows_the_labels(spark):
    rows, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_report(rows, quality.fit(rows, labels)).join(labels, "doc_id").where("not base_failed")
    assert got.where("quality = 1 and not kept").count() == 0 and got.where("quality = 0 and kept").count() <= 1


def test_near_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((30, 16))
    rows = [(k, (centres[k % 30] + 0.12 * rng.standard_normal(16)).tolist()) for k in range(300)]
    rows += [(300, rows[0][1]), (301, None), (302, [0.0] * 16), (303, [float("nan")] * 16), (304, [1.0, None]), (305, []), (306, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embeddings.near_vectors(table).collect()}
    v = np.array([x for _, x in rows[:301]])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T >= 0.9
    label = np.arange(301)
    while (new := np.where(near, label[None, :], 10**6).min(axis=1)).tolist() != label.tolist():
        label = new
    assert [got[k]["n_links"] for k in range(301)] == (near.sum(axis=1) - 1).tolist()
    assert [got[k]["component_id"] for k in range(301)] == label.tolist()
    assert all(got[k]["n_links"] == 0 and got[k]["kept"] for k in range(301, 307))
    assert embeddings.near_vectors(table.limit(0)).collect() == []


def test_near_vectors_at_the_threshold_and_repeated_ids(spark):
    above, below = 0.9 + 1e-13, 0.9 - 1e-13
    a, near = [1.0, 0.0], [above, (1 - above**2) ** 0.5]
    rows = [(1, a), (2, near), (11, [0.0, 0.0, 1.0]), (12, [0.0, (1 - below**2) ** 0.5, below]), (7, a), (7, [-1.0, 0.0]), (8, [-1.0, 0.0]), (9, [-1.0, 0.0])]
    got = [tuple(r) for r in embeddings.near_vectors(spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, n_links string, label int")).collect()]
    by_id = {r[0]: r[1:] for r in got}
    assert len(got) == 8 and sum(r[0] == 7 for r in got) == 2
    assert by_id[2] == (2, 1, False) and by_id[11] == (0, 11, True) and by_id[12] == (0, 12, True)
    assert by_id[7] == (2, 1, False) and by_id[8] == by_id[9] == (2, 7, False)


def planted_pairs(spark, pairs):
    rng = np.random.default_rng(8)
    x, noise = rng.standard_normal((2, pairs, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    v = np.stack([x, 0.91 * x + np.sqrt(1 - 0.91**2) * noise], axis=1).reshape(-1, 64)
    return spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(v)], "vec_id long, embedding array<double>")


def test_near_vectors_do_not_depend_on_partitions(spark):
    table, before, got = planted_pairs(spark, 500), spark.conf.get("spark.sql.shuffle.partitions"), {}
    try:
        for parts in (2, 30):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got[parts] = {tuple(r) for r in embeddings.near_vectors(table).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[2] == got[30] and sum(r[1] for r in got[2]) >= 0.98 * 1000
    copies = spark.range(2500).selectExpr("id AS vec_id", "array(1.0D, 2.0D) AS embedding")
    assert {tuple(r)[1:3] for r in embeddings.near_vectors(copies).collect()} == {(2499, 0)}


def test_near_vectors_recall_over_many_windows(spark):
    assert [embeddings.plan(64, n, 0.9)[0] for n in (10**5, 10**6, 10**8)] == [1, 2, 3]
    # 1,000 vectors are 125 blocks
    assert embeddings.near_vectors(planted_pairs(spark, 500), block=8).where("n_links > 0").count() >= 0.98 * 1000


def test_near_vectors_of_one_run_all_meet(spark):
    v = np.eye(40)
    v[39] = v[0]
    ranked = spark.createDataFrame([(40, 7, k, k) for k in range(40)], "dim int, run long, id long, rank long")
    half = spark.createDataFrame([(k, bytearray(x.astype(np.float16).tobytes())) for k, x in enumerate(v)], "id long, half binary")
    links = embeddings.neighbour_links(embeddings.met(ranked, half, 40, 2, block=4), 0.9, block=4)
    assert {frozenset((r["a"], r["b"])) for r in links.collect()} == {frozenset((0, 39))}


def test_tokens(docs):
    rows = bpe.decode(bpe.encode(docs, VOCABULARY, decoded="row"), VOCABULARY).collect()
    assert len(rows) == docs.count() and all(r["row"] == r["decoded"] for r in rows)
    assert all((len(r["ids"]) == 0) == (not (r["text"] or "").strip()) for r in rows)


def test_tokens_query_matches_the_library(spark, scratch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows += [(None, "It's <|endoftext|> ΣΑΣ"), (-1, None), (-2, ""), (-2, ""), (-3, "word's " * 400_000), (-4, "é" * 300)]
    spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, n_tokens int").write.parquet(f"{scratch}/documents.parquet")

    def want(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        return len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in shown)

    got = queries.op10_tokens(spark, scratch)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(((i, *want(t)) for i, t in rows), key=repr)


def test_pipeline(docs, spark, scratch):
    docs.withColumn("n_chars", F.col("n_chars")).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    rows = corpus_pipeline.run(spark, scratch)
    assert rows.columns == [*docs.columns, "ids", "decoded"]
    assert {r["doc_id"] for r in rows.collect()} <= {1, 8, None}
