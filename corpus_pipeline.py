"""A training corpus from raw documents: clean, deduplicate, thin near copies, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
back as the next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakesteps.llm import bpe, exact_dedup, mixing, order_minhash, quality_rules
from lakesteps.session import materialize


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail the rules go, and documents that lose too much or fail as a whole."""
    return quality_rules.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.keep_one_copy(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies the smallest doc_id stays."""
    return order_minhash.keep_one_of_class(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that tokens meet the source, language and topic targets."""
    return mixing.sample_to_targets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its token count and the digests of its ids and decoded text."""
    return bpe.encoded_digests(docs)


STAGES = [
    ("quality_rules", clean),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("mixing", mix),
    ("bpe", encode),
]

#: Near duplicates and byte-pair encoding have no SQL form; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
