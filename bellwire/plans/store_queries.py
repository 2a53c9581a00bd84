"""Queries that write a table through a sink or a stream and give back what was stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bellwire.functions import messages as M
from bellwire.functions import scalars as S
from bellwire.operators import bars as B
from bellwire.operators import linking as K
from bellwire.operators import models as P
from bellwire.plans import fixtures as X
from bellwire.session import scratch_path
from bellwire.sources import files, keyed_table, messages, sinks
from bellwire.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOPIC = "value BINARY, partition INT, offset BIGINT"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def drained(started: StreamingQuery) -> None:
    """Wait for a stream that takes what is there; its failure fails the query."""
    started.awaitTermination()


def ingested(spark: SparkSession, d: str) -> str:
    """Where the ingest job has stored all messages, read as a topic of four partitions.

    The job is run a second time on the same checkpoint, which must store nothing again.
    """
    topic, out, offsets = (scratch_path(spark, n) for n in ("topic", "ingest", "ingest-offsets"))
    X.messages(spark, d).select(
        F.col("value").cast("binary").alias("value"),
        (F.col("doc_id") % 4).cast("int").alias("partition"),
        F.col("doc_id").alias("offset"),
    ).write.parquet(topic)
    for _ in range(2):
        stream = messages.message_stream(spark, "parquet", TOPIC, topic, maxFilesPerTrigger="64")
        decoded = messages.decoded(stream)
        drained(jobs.start_ingest(decoded, out, offsets, jobs.drain_trigger()))
    return out


@query
def stream_ingest_table(spark, d):
    return spark.read.parquet(f"{ingested(spark, d)}/news").select(
        F.col("offset").alias("doc_id"), "news_time", "news_title",
        F.md5("news_article").alias("article_md5"),
    )


@query
def stream_dead_letter_table(spark, d):
    return spark.read.parquet(f"{ingested(spark, d)}/dead_letters").select(
        F.col("offset").alias("doc_id"), "reason", F.char_length("value").alias("n_chars")
    )


@query
def stream_counters(spark, d):
    """Messages, accepted and refused ones, as the batches of the ingest job have counted them."""
    counted = spark.read.parquet(f"{ingested(spark, d)}/counters")
    by_reason = [F.sum(F.col("reasons")[r]).alias(r) for r in M.REASONS]
    names = ("messages", "accepted", "refused")
    return counted.agg(*[F.sum(c).alias(c) for c in names], *by_reason)


@query
def stream_offsets(spark, d):
    audit = spark.read.parquet(f"{ingested(spark, d)}/offsets")
    return audit.groupBy(F.col("partition").alias("topic_partition")).agg(
        F.min("min_offset").alias("min_offset"),
        F.max("max_offset").alias("max_offset"),
        F.sum("n").alias("n"),
    )


@query
def stream_high_water(spark, d):
    """Two polls of a feed folder: even documents come first, odd ones later."""
    folder, out, offsets = (scratch_path(spark, n) for n in ("feeds", "new-items", "feed-offsets"))
    items = X.feed_items(spark, d).select("feed", "news_time", "doc_id")
    for rest in (0, 1):
        items.where(F.col("doc_id") % 2 == rest).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(items.schema).parquet(folder)
        drained(jobs.start_high_water(stream, out, offsets, trigger=jobs.drain_trigger()))
    return spark.read.parquet(f"{out}/items").select("doc_id", "feed", "news_time", "batch_id")


@query
def stream_daily_once(spark, d):
    """Symbols and days of the stored snapshots, and how many of each were stored."""
    folder, out, offsets = (scratch_path(spark, n) for n in ("ticks", "daily", "daily-offsets"))
    ticks = X.ticks(spark, d).select("symbol", F.col("ts").cast("timestamp").alias("ts"), "value")
    ticks.write.parquet(folder)
    stream = jobs.daily_once(spark.readStream.schema(ticks.schema).parquet(folder))
    drained(jobs.start_append(stream, out, offsets, jobs.drain_trigger()))
    return spark.read.parquet(out).groupBy("symbol", "date").agg(F.count("*").alias("n"))


@query
def append_table(spark, d):
    """Two appends to one collection; rows are counted while they are written."""
    path = scratch_path(spark, "collection")
    docs = X.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    english = F.col("lang").eqNullSafe("en")
    written = []
    for part in (docs.where(english), docs.where(~english)):
        counted, counters = sinks.observed(part, "appended")
        sinks.append_rows(counted, path)
        written.append(counters.get["rows"])
    return spark.read.parquet(path).withColumn("n_written", F.lit(sum(written)).cast("long"))


@query
def write_once(spark, d):
    """A second write to a path that is there already changes nothing."""
    path = scratch_path(spark, "once")
    first = X.snapshot(spark, d)
    sinks.write_if_absent(first, path)
    sinks.write_if_absent(first.withColumn("name", F.lit("other")), path)
    return spark.read.parquet(path)


@query
def by_symbol_table(spark, d):
    path = scratch_path(spark, "by-symbol")
    sinks.write_by_symbol(X.news(spark, d), path)
    return spark.read.parquet(path).select("news_id", "news_time", "symbol")


@query
def word_list(spark, d):
    """Names written as lines with blanks around them and blank lines between."""
    path = scratch_path(spark, "words")
    lines = F.explode(F.array(F.concat(F.lit(" \t"), "name", F.lit("  ")), F.lit("  ")))
    X.names(spark, d).select(lines.alias("value")).write.text(path)
    return files.word_list(spark, path)


@query
def csv_news(spark, d):
    """News with line breaks, quotes and commas in its articles, through a CSV file."""
    path = scratch_path(spark, "news-csv")
    news = X.news_docs(spark, d).select(
        F.date_format("news_time", "yyyy-MM-dd HH:mm:ss").alias("news_time"),
        F.concat(F.lit('"id", '), "doc_id", F.lit("\n"), "news_article", F.lit("\n.")).alias("news_article"),
    )
    files.write_csv(news, path)
    return files.read_news_csv(spark, path).select("news_time", F.md5("news_article").alias("article_md5"))


@query
def strip_blank(spark, d):
    bare = S.strip_blank(F.concat(F.lit(" \n"), "news_title", F.lit("\t ")))
    return X.news_docs(spark, d).select("doc_id", F.md5(bare).alias("title_md5"), (bare == "").alias("blank"))


@query
def model_reload(spark, d):
    """Features of each bar from stages that were fitted, stored and loaded again."""
    path = scratch_path(spark, "model")
    featured = B.bar_features(X.bars_ev(spark, d))
    sinks.save_model(Pipeline(stages=P.feature_stages()).fit(featured), path)
    loaded = sinks.load_model(PipelineModel, path)
    vectors = loaded.transform(featured).withColumn("vector", vector_to_array("features"))
    return vectors.select(
        "symbol", "date",
        *[(F.round(F.get("vector", i), 6) + F.lit(0.0)).alias(f"f{i}") for i in range(7)],
    )


@query
def stored_update(spark, d):
    """A stored table of articles: codes written back by id, then the articles of toxic documents marked."""
    docs = X.news_docs(spark, d).select("doc_id", "feed", "news_time", F.md5("news_article").alias("article_md5"))
    table = keyed_table.KeyedTable(spark, scratch_path(spark, "articles"), "doc_id", buckets=16)
    table.create(docs)
    hits = K.mention_hits(X.news_docs(spark, d), X.names(spark, d), X.stop_words(spark, d), ["doc_id"])
    codes = K.joined_codes(F.col("relevant_symbols"))
    table.patch(K.relevant_symbols(hits).select("doc_id", codes.alias("codes")))
    toxic = X.table(spark, d, "labels").where("toxic = 1")
    table.patch(toxic.select("doc_id", F.lit("toxic").alias("feed"), F.lit(None).cast("timestamp_ntz").alias("news_time")))
    return table.read()
