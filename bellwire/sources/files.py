"""CSV tables and word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwire.functions import scalars as S

# Columns of the CSV inputs.
BAR_SCHEMA = "symbol STRING, date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"
PRICE_SCHEMA = "date STRING, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"
NEWS_SCHEMA = "news_time STRING, news_article STRING"


def read_csv(
    spark: SparkSession, path: str, schema: str, multi_line: bool = False, mode: str = "PERMISSIVE"
) -> DataFrame:
    """A header CSV with a declared schema: no inference pass over the data.

    ``multi_line`` reads quoted line breaks; each file is then one task, so large tables
    should be many files.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("mode", mode)
        .option("escape", '"')
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def read_bars_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, BAR_SCHEMA)


def read_prices_csv(spark: SparkSession, path: str, symbol: str) -> DataFrame:
    """Prices of one symbol, dates as wall-clock time without their offset."""
    rows = read_csv(spark, path, PRICE_SCHEMA)
    return rows.select(
        F.lit(symbol).alias("symbol"),
        S.naive_timestamp(F.col("date")).cast("date").alias("date"),
        "open",
        "high",
        "low",
        "close",
        "volume",
    )


def read_news_csv(spark: SparkSession, path: str) -> DataFrame:
    """News with line breaks inside quotes; a broken record fails the read."""
    rows = read_csv(spark, path, NEWS_SCHEMA, multi_line=True, mode="FAILFAST")
    return rows.withColumn("news_time", S.naive_timestamp(F.col("news_time")))


def word_list(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """``(word)``: the lines of a file, trimmed, without blank ones.

    The text reader knows only UTF-8, so other encodings are decoded from the
    bytes of the file; that needs the full charset set while the plan is built.
    """
    if encoding.upper() in ("UTF-8", "UTF8"):
        lines = spark.read.text(path).select(F.col("value").alias("word"))
    else:
        flag = "spark.sql.legacy.javaCharsets"
        before = spark.conf.get(flag, "false")
        spark.conf.set(flag, "true")
        try:
            files = spark.read.format("binaryFile").load(path)
            whole = files.select(F.decode("content", encoding).alias("_text"))
            lines = whole.select(F.explode(F.split("_text", "\r?\n")).alias("word"))
        finally:
            spark.conf.set(flag, before)
    return lines.select(S.strip_blank(F.col("word")).alias("word")).where("word <> ''")


def bounded_words(words: DataFrame, max_words: int = 1_000_000) -> list[str]:
    """A word list for use inside tasks; more words than the bound is an error."""
    rows = words.select("word").limit(max_words + 1).collect()
    if len(rows) > max_words:
        raise ValueError(f"the word list has more than {max_words} words")
    return [r["word"] for r in rows]
