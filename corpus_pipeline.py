"""A corpus pipeline: quality rules, near-dedup, decontamination, masking of personal data, piece encoding.

Every stage works on whatever its predecessor kept, and all but the last return the columns of
``documents``. A document that a stage rejects is gone for the next one.

Edge cases: null and empty texts fail the quality rules; rows with a null or repeated id are documents of
their own, of equal rows one stays; null benchmark items match nothing; without labels only the base rules
reject; empty tables give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.llm import merge_dropout, order_minhash, pii, qgram, quality_rules
from aferir.llm.common import read, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one with the smallest id."""
    return order_minhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return qgram.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by markers; n_chars follows the text."""
    return pii.mask_texts(docs).withColumn("n_chars", F.length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    return merge_dropout.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("pii", mask),
    ("pieces", encode),
]
#: No SQL expresses the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs)
    return docs
