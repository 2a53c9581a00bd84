"""Views over the test tables that give every operator real input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwire.functions import messages as M
from bellwire.functions import text as T
from bellwire.operators import bars as B
from bellwire.operators import linking as L


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Text rows over all cores when the files give fewer partitions than cores.

    Large tables have more files than that and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "lineitem"), "l_orderkey")


def code(number: Column) -> Column:
    return F.concat(F.lit("sh"), F.lpad(number.cast("string"), 6, "0"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(code(F.col("user_id")).alias("symbol"), "ts", "value", "event_type")


def bars_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of event values per user and day."""
    return B.bars_from_ticks(
        ticks(spark, sf_dir),
        symbol=F.col("symbol"),
        moment=F.col("ts"),
        price=F.col("value"),
        order=F.col("ts"),
        volume=F.count("*"),
    )


def bars_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of unit prices per brand and shipping day."""
    items = lineitem(spark, sf_dir).join(
        table(spark, sf_dir, "part").select("p_partkey", "p_brand"),
        F.col("l_partkey") == F.col("p_partkey"),
    )
    return B.bars_from_ticks(
        items,
        symbol=F.col("p_brand"),
        moment=F.col("l_shipdate"),
        price=F.col("l_extendedprice") / F.col("l_quantity"),
        order=F.struct(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
        ),
        volume=F.sum("l_quantity"),
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as news on each brand they hold, at midnight or within the day."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    items = lineitem(spark, sf_dir).select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    minutes = F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("o_orderkey") % 1440).cast("int")
    )
    linked = (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", "p_brand")
        .distinct()
    )
    return linked.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("news_id"),
        (F.col("o_orderdate") + minutes).alias("news_time"),
        F.col("p_brand").alias("symbol"),
    )


def news_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles of three feeds."""
    minutes = F.make_dt_interval(
        F.lit(0), F.lit(0), ((F.col("doc_id") * 37) % 43200).cast("int")
    )
    return documents(spark, sf_dir).select(
        "doc_id",
        F.concat(F.lit("src"), (F.col("doc_id") % 3).cast("string")).alias("feed"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + minutes).alias("news_time"),
        F.split_part(F.col("text"), F.lit("\n"), F.lit(1)).alias("news_title"),
        F.col("text").alias("news_article"),
    )


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles in feed order, newest first, some of them undated."""
    dated = F.when(F.col("doc_id") % 10 == 4, "").otherwise(
        F.date_format("news_time", "yyyy-MM-dd HH:mm")
    )
    return news_docs(spark, sf_dir).select(
        "feed", (-F.col("doc_id")).alias("position"), "doc_id", dated.alias("news_time")
    )


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return T.token_rows(
        items.select("item_id", T.tokens(F.col("text")).alias("_words")), "_words", "item_id"
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names listed by each benchmark item, whose number is their symbol."""
    words = benchmark_words(spark, sf_dir).where(F.char_length("token") >= L.MIN_NAME_CHARS)
    return words.select(
        F.col("token").alias("name"),
        code(F.col("item_id")).alias("symbol"),
        F.col("item_id").alias("load_order"),
    )


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.symbol_lookup(listings(spark, sf_dir))


def stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of the benchmark."""
    counts = benchmark_words(spark, sf_dir).groupBy("token").count()
    return counts.where("count >= 10").select(F.col("token").alias("word"))


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages; every second one gets a URL with a date in its path."""
    day = F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    hour = F.lpad((F.col("page_id") % 24).cast("string"), 2, "0")
    minute = F.lpad((F.col("page_id") % 60).cast("string"), 2, "0")
    dated = F.concat(
        F.lit("https://news.example.com/2024/11/"), day, hour, minute, "page_id", F.lit(".shtml")
    )
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(F.col("page_id") % 2 == 0, dated).otherwise(F.col("url")).alias("url"),
        "html",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as JSON messages, some of them broken in each of the known ways."""
    docs = news_docs(spark, sf_dir).withColumn(
        "news_time", F.date_format("news_time", "yyyy-MM-dd HH:mm")
    )
    keep = {"ignoreNullFields": "false"}
    kind = F.col("doc_id") % 10

    def as_json(*columns: Column) -> Column:
        return F.to_json(F.struct(*columns), keep)

    return docs.select(
        "doc_id",
        F.when(kind == 0, "not json")
        .when(kind == 1, "[1,2]")
        .when(kind == 2, as_json(F.col("news_time"), F.col("news_article")))
        .when(
            kind == 3,
            as_json(
                F.col("news_time"),
                F.lit(None).cast("string").alias("news_title"),
                F.col("news_article"),
            ),
        )
        .when(
            kind == 4,
            as_json(
                F.col("news_time"), F.col("news_title"), F.col("doc_id").alias("news_article")
            ),
        )
        .otherwise(as_json(*[F.col(k) for k in M.KEYS]))
        .alias("value"),
    )


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last bar of each symbol as a market snapshot."""
    fields = ["open", "high", "low", "close", "volume"]
    last = bars_ev(spark, sf_dir).groupBy("symbol").agg(
        F.max_by(F.struct(*fields), "date").alias("bar")
    )
    return last.select(
        "symbol",
        F.concat(F.lit("N"), "symbol").alias("name"),
        "bar.open",
        "bar.high",
        "bar.low",
        F.col("bar.close").alias("trade"),
        "bar.volume",
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as news in the time of the events, by the minute; every third one is on one symbol."""
    orders = table(spark, sf_dir, "orders")
    day = F.date_diff("o_orderdate", F.lit("1995-01-01").cast("date")) % 32
    minutes = F.make_dt_interval(day, F.lit(0), (F.col("o_orderkey") * 7 % 1440).cast("int"))
    user = F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.floor(F.col("o_custkey") / 10))
    return orders.select(
        F.col("o_orderkey").alias("news_id"),
        code(user).alias("symbol"),
        (F.lit("2023-12-31 00:00:00").cast("timestamp_ntz") + minutes).alias("news_time"),
    )


def minute_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks by the minute, so that some fall on the minute of a trade and some on one another's."""
    return ticks(spark, sf_dir).select(
        "symbol", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("tick_time"), F.col("value").alias("tick_value")
    )


# Letters and the Chinese characters that stand for them.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
CHARACTERS = "的一是在不了有和人这中大为上个国我以要他时来用们生到"


def han_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose letters a to z are Chinese characters; other letters, digits and blanks end a run."""
    text = F.translate(F.lower("text"), LETTERS, CHARACTERS)
    return documents(spark, sf_dir).select("doc_id", text.alias("text"))


def han_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the benchmark of 2 to 6 letters, and the first three letters of longer ones, in Chinese characters."""
    token = benchmark_words(spark, sf_dir).where(F.col("token").rlike("^[a-z]{2,}$")).select("token").distinct()
    short = F.when(F.char_length("token") <= 6, F.col("token")).otherwise(F.substring("token", 1, 3))
    return token.select(F.translate(short, LETTERS, CHARACTERS).alias("word")).distinct()
