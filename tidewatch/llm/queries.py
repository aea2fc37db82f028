"""The queries of this subpackage, one per operator, over whole tables."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bpe, embeddings, html_text, langid, lm, minhash, mixing, pii, quality, quotes, runs, sharding, trie
from tidewatch.llm.common import documents, held_out_share, stored

#: folder of the public vocabulary files
TOKENIZERS = os.environ.get("TIDEWATCH_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


#: lookup table of the usual CRC-32 as a list, and the CRC-32 of a text with it
CRC_TABLE = """SELECT list(v ORDER BY k) AS crc FROM (
    SELECT k, list_reduce(list_prepend(k, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(k))"""
CRC_TEXT = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda a, b: xor(a >> 8, crc[1 + (xor(a, b) & 255)])), 4294967295)"""


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), size=4, percent=80)


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    predicted = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return predicted.select("doc_id", (held_out_share("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = lm.score(docs, lm.fit(lm.learning(docs)))
    return scored.select("doc_id", (held_out_share("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op5_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = quotes.formatted(table(spark, sf_dir, "conversations"))
    return chat.select("conv_id", "turn", "role", "reply_conv", "reply_turn", "root_conv", "root_turn", "depth", "place", "n_quoted_lines", "chat")


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["found"] == "rule")

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


@query
def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(documents(spark, sf_dir))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.quality_report(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query
def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = bpe.read_vocabulary(f"{TOKENIZERS}/{VOCABULARY}")
    rows = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), source, decoded="decoded")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tailed = runs.with_repeated_tail(documents(spark, sf_dir).select("doc_id", "text"))
    found = runs.periodic_runs(tailed)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[name].cast("string") for name in ("start", "length", "period"))), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")),
        runs.exponent_milli("best").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = documents(spark, sf_dir).select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.with_shard(sharding.with_shard(rows, "doc_id", [1.0] * 8), "doc_id", [1.0] * 9, "grown_shard")
    slotted = sharding.with_slot(placed, "shard", ["doc_id", "size", "text_crc32"])
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _winner(shards: int) -> str:
    drawn = "('0x' || substr(md5(s || ':' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT"
    return f"list_reduce(range(1, {shards}), lambda a, s: CASE WHEN {drawn} > {drawn.replace('(s ||', '(a ||')} THEN s ELSE a END, 0::BIGINT)::INT"


SQL["op12_shards"] = f"""WITH t AS ({CRC_TABLE}),
    d AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {CRC_TEXT.format(text="coalesce(text, '')")} AS text_crc32, {_winner(8)} AS shard, {_winner(9)} AS grown_shard FROM documents, t)
    SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
        row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot FROM d"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, members = trie.rebuilt(stored(trie.numbered(table(spark, sf_dir, "conversations")), "numbered"))
    tree = trie.build(rows, members)
    nodes = trie.with_totals(tree).join(trie.end_digests(tree.ends), "key", "left")
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


SQL["op13_prefix_trie"] = f"""WITH t AS ({CRC_TABLE}),
    o AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    h AS (SELECT *, ({CRC_TEXT.format(text="conv_id::VARCHAR")} % 4)::INT AS h, conv_id - conv_id % 20 AS base FROM o, t),
    c AS (SELECT h.conv_id, list_concat(coalesce(b.turns, [])[:h.h], h.turns[h.h + 1:]) AS seq FROM h LEFT JOIN o b ON b.conv_id = h.base),
    m AS (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS depth FROM c),
    n AS (SELECT min(conv_id) AS conv_id, depth, count(*) AS n_convs, any_value(seq)[:depth] AS pre,
        sha256(coalesce(string_agg(CASE WHEN len(seq) = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
        FROM m GROUP BY depth, seq[:depth]),
    k AS (SELECT n.*, p.conv_id AS parent_conv_id FROM n LEFT JOIN n p ON p.depth = n.depth - 1 AND p.pre = n.pre[:n.depth - 1]),
    f AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM k WHERE depth > 0 GROUP BY ALL),
    w AS (SELECT k.*, coalesce(f.n_children, 0) AS n_children,
        CASE WHEN depth > 0 THEN (n_convs - 1) * len(regexp_extract_all(pre[depth].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved FROM k LEFT JOIN f USING (conv_id, depth)),
    u AS (SELECT x.depth, x.pre, sum(y.saved)::BIGINT AS saved_tokens, count(*) FILTER (y.n_children = 0) AS n_leaves
        FROM w x JOIN (SELECT *, unnest(range(depth + 1)) AS above FROM w) y ON y.above = x.depth AND y.pre[:y.above] = x.pre GROUP BY x.depth, x.pre)
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM w JOIN u USING (depth, pre)"""
