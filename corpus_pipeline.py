"""Documents to training tokens: quality, near-duplicates, personal data, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage
returns to the shared folder and reads it back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import bpe, minhash, mixing, pii, quality
from tidewatch.llm.common import documents, stored
from tidewatch.llm.queries import TOKENIZERS, VOCABULARY


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail them go."""
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates on shingles of five words at 0.8: one document of each group stays."""
    return minhash.keep_one(docs, size=5, percent=80)


def private_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data: every span is replaced by its kind."""
    return pii.redact(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixture: a document comes as often as its source's target wants."""
    return mixing.mixed(docs)


def token_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the whole text, and the text they decode to."""
    source = bpe.read_vocabulary(f"{TOKENIZERS}/{VOCABULARY}")
    return bpe.encode(docs, source, decoded="decoded")


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("personal_data", private_documents),
    ("mixture", mixed_documents),
    ("tokens", token_documents),
]

#: the trained ratio, the sketches and the pivotal walk have no SQL form; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
