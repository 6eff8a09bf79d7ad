"""A training corpus from raw documents: quality, near-duplicates, benchmark leaks, personal data, tokens.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns
the next stage's documents. Each result is written as parquet before the next stage reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, decontaminate, jaccard, pii, quality
from martloom.llm.common import crc_mod, staged, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects; it learns from the labelled ones that are not held out."""
    learn = crc_mod("doc_id", 5) != 0
    stats = staged(quality.with_statistics(docs.where(learn)))
    model = quality.fit(stats, table(spark, sf_dir, "labels").where(learn))
    return quality.keep_good(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    return jaccard.first_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that contain a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With personal data masked, and n_chars set to the new length."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number, and the hash of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN, decode=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", decontaminated),
    ("personal_data", redacted),
    ("tokens", tokenized),
]

# The stages are a classifier, components, a search index and a tokenizer: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
