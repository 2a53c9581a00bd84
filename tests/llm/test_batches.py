"""Batches of texts between the JVM and Python are bounded by bytes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bellwire.llm import queries
from bellwire.session import BATCH, bound_batches


@pytest.fixture
def unset(spark):
    before = spark.conf.get(BATCH)
    spark.conf.unset(BATCH)
    yield spark
    spark.conf.set(BATCH, before)


def test_batches_are_bounded_by_bytes(unset, tmp_path):
    spark = unset
    rows = spark.range(0, 200, 1, 1).select(
        F.col("id").alias("doc_id"), F.format_string("%d ", "id").alias("head"), F.repeat(F.lit("some words "), 8192).alias("tail")
    )
    docs = rows.select("doc_id", F.concat("head", "tail").alias("text"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows * 8192 * 11])], names=["n"])

    def largest():
        return docs.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]

    assert largest() > 16 << 20
    queries.op7_line_dedup(spark, str(tmp_path))
    assert largest() < 6 << 20
    spark.conf.unset(BATCH)
    corpus_pipeline.sequences(spark, docs, str(tmp_path))
    assert largest() < 6 << 20


def test_a_size_that_is_set_stays(unset):
    unset.conf.set(BATCH, "1m")
    bound_batches(unset)
    assert unset.conf.get(BATCH) == "1m"
