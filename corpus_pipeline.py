"""A training corpus from raw documents: five stages, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from playlake.llm import decontamination, near_dedup, pieces, quality_rules, suffix_dedup
from playlake.llm.rows import stored

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates."""
    return near_dedup.keep_first(docs)


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 240 bytes that start in two places, some 50 words each.

    Every copy of such a passage goes, the first one too.
    """
    return suffix_dedup.without_repeats(docs, suffix_dedup.PASSAGES)


def no_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, without passages of test items."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids and byte spans of every document, their number, and digests of ids and decoded text."""
    return pieces.encoded(docs, PIECE_MODEL)


STAGES = [
    ("quality rules", good_documents),
    ("near-dedup", one_of_each),
    ("suffix-array dedup", no_repeats),
    ("decontamination", no_leaks),
    ("sentencepiece", piece_ids),
]

#: None: SQL can express neither the classes of similar texts nor the pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is stored and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
