"""Quality models: fitted on all labels, the threshold placed in ranges as on one array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidewatch.llm import quality
from tidewatch.llm.common import text_bytes


def plain_threshold(scores, trusted):
    """Mistakes at every place, one by one."""
    distinct = sorted(set(scores))
    edges = [distinct[0] - 1, *((a + b) / 2 for a, b in zip(distinct, distinct[1:])), distinct[-1] + 1]
    cost = [quality.CARE * (trusted & (scores < e)).sum() / trusted.sum() + (~trusted & (scores >= e)).sum() / (~trusted).sum() for e in edges]
    return edges[int(np.argmin(cost))]


def test_fit_uses_every_label(spark):
    """24,000 labelled documents: counts and threshold are those over all of them."""
    n = 24_000
    drawn = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 6), 16, 10).cast("int")
    word = F.when(drawn % 7 == 0, "zq").otherwise("an")
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.concat(word, ((drawn + k * 7919) % (1000 + k)).cast("string")) for k in range(11))).alias("text"))
    labels = docs.select("doc_id", F.when(drawn_label(docs), 0).otherwise(1).alias("quality"))
    ratio = quality.fit(docs, labels)

    rows = docs.join(labels, "doc_id").orderBy("doc_id").toPandas()
    trusted = rows["quality"].to_numpy() == 1

    def counted(texts):
        data, offsets = text_bytes(pa.array(texts))
        bucket, valid = quality.trigrams(data, offsets)
        return np.bincount(bucket[valid], minlength=1 << quality.BITS)

    raw, target = counted(rows["text"]), counted(rows["text"][trusted])
    q = (raw + 1) / (raw.sum() + len(raw))
    p = (target + 100.0 * q * 10) / (target.sum() + 1000.0)
    assert (ratio.table == np.round(np.log(p / q) * quality.UNIT)).all()
    data, offsets = text_bytes(pa.array(rows["text"]))
    scores = quality.mean_ratio(ratio.table, data, offsets)
    some = ~quality.measures(data, offsets, list(rows["text"]))["base_failed"]
    assert some.sum() > 20_000
    assert ratio.threshold == quality.place_threshold(scores[some], trusted[some])


def drawn_label(docs):
    return (F.col("text").startswith("zq") & (F.col("doc_id") % 5 != 0)) | (F.col("doc_id") % 97 == 0)


def test_threshold_in_ranges(spark):
    for seed in range(3):
        rng = np.random.default_rng(seed)
        trusted = rng.random(700) < (0.5, 0.9, 0.02)[seed]
        scores = np.round(rng.standard_normal(700) + 2.0 * trusted, 2)  # with ties
        rows = spark.createDataFrame([(float(s), int(t)) for s, t in zip(scores, trusted)], "score double, quality int")
        want = plain_threshold(scores, trusted)
        assert quality.place_threshold(scores, trusted) == want and quality.threshold_of(rows) == want
    assert quality.threshold_of(rows.where("quality = 1")) == quality.threshold_of(rows.limit(0)) == -np.inf
