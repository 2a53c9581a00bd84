"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwire.llm import (
    chat_format,
    embedding_dedup,
    hard_negatives,
    licenses,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    prefix_trie,
    quality,
    secret_scan,
    url_rules,
    warc,
)
from bellwire.session import bound_batches

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    """Where the public vocabulary lies on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_license_scan(spark, d):
    return licenses.digest(licenses.scan(table(spark, d, "documents")))


def op2_ngram_jaccard(spark, d):
    return ngram_join.join(table(spark, d, "documents"))


def op3_secret_scan(spark, d):
    return secret_scan.digest(secret_scan.scan(table(spark, d, "documents")))


def op4_mixing(spark, d):
    return mixing.mix_report(table(spark, d, "documents"))


def op5_packing(spark, d):
    bound_batches(spark)
    return packing.pack(table(spark, d, "documents"), word_bpe())


def op6_quality_rules(spark, d):
    return quality.report(table(spark, d, "documents"), table(spark, d, "labels"))


def op7_line_dedup(spark, d):
    bound_batches(spark)
    return line_dedup.dedup_report(table(spark, d, "documents"))


def op8_embedding_dedup(spark, d):
    return embedding_dedup.link(table(spark, d, "embeddings"))


def op9_warc(spark, d):
    return warc.digest(warc.round_trip(table(spark, d, "pages")))


def op10_url_filter(spark, d):
    judged = url_rules.judge(table(spark, d, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_hard_negatives(spark, d):
    """Anchors are the rows whose id is divisible by 100; every seventh row has another label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, d, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_prefix_trie(spark, d):
    return prefix_trie.prefix_trie(table(spark, d, "conversations"))


def op13_chat_format(spark, d):
    """All conversations, and one that holds the template's control strings."""
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionAll(more)
    return chat_format.digest(chat_format.format_conversations(rows))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_ngram_jaccard,
        op3_secret_scan,
        op4_mixing,
        op5_packing,
        op6_quality_rules,
        op7_line_dedup,
        op8_embedding_dedup,
        op9_warc,
        op10_url_filter,
        op11_hard_negatives,
        op12_prefix_trie,
        op13_chat_format,
    )
}
