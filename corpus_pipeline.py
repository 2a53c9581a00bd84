"""The training-data pipeline: five stages from ``documents`` to packed sequences.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read as the
next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bellwire.llm import line_dedup, mixing, ngram_join, packing, quality
from bellwire.llm.queries import table, word_bpe
from bellwire.session import bound_batches, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or a proven cut-off go."""
    bound_batches(spark)
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def line_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go; every document stays."""
    bound_batches(spark)
    return line_dedup.dedup_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-equal documents the one with the smallest id stays."""
    bound_batches(spark)
    return ngram_join.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out until each source has its share."""
    return mixing.mix_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    bound_batches(spark)
    return packing.pack(docs, word_bpe())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_duplicates),
    ("ngram_jaccard", near_duplicates),
    ("mixing", source_mix),
    ("packing", sequences),
]

# Binomial bounds and token ids are beyond SQL; tests compare run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
