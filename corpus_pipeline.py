"""A corpus pipeline: toxicity, exact deduplication, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir), with docs read from Parquet, and works on all that its predecessor kept; all but the last return
the columns of documents. Toxic documents go; of equal texts the smallest doc_id stays, and of each near-duplicate group; secrets are
redacted; what is left is packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from holdlens.llm import bpe, exact_dedup, packing, secrets, simjoin, toxicity
from holdlens.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simjoin.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    words = secrets.common_words(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return secrets.redact(docs, secrets.train(secrets.labelled_findings(spark), dictionary=words))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return packing.pack(docs, tokenizer_json=f.read())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: The stages' models can't be written as SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
