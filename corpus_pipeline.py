"""From raw documents to token ids: the stages of the corpus pipeline, one after the other.

Every stage is written as Parquet below the folder that all executors share and read again by the
next one, so that a stage works on exactly what the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_engine.llm import bpe, exact_dedup, mixing, quality, simhash
from transit_engine.llm.common import saved, table
from transit_engine.session import configure

VOCABULARY = "byte_bpe_50k.tiktoken"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble takes for good ones."""
    return quality.accepted(docs, table(configure(spark), sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id."""
    configure(spark)
    return exact_dedup.survivors(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked the one with the smallest doc_id.

    The fingerprints are those of the operator's contract: three-word shingles, 3 differing bits.
    """
    configure(spark)
    return simhash.survivors(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    configure(spark)
    return mixing.mixture(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document taken."""
    configure(spark)
    coded = bpe.encoded(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("simhash_dedup", without_near_copies),
    ("mixing", mixed_sources),
    ("byte_bpe", token_ids),
]

# The stages of quality, fingerprints and tokens have no SQL; tests hold the rows against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
