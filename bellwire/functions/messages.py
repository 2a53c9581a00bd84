"""Shape checks and parsing of JSON news messages.

A message is parsed once, as a variant; key presence, types and values are then
read from it, row by row, so a bad message never harms its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bellwire.functions import scalars as S

# Keys every message has.
KEYS = ("news_time", "news_title", "news_article")
SCHEMA = "news_time STRING, news_title STRING, news_article STRING"


# Why a message is refused.
REASONS = ("bad_json", "not_object", "missing_key", "bad_type")


def _part(key: str) -> Column:
    return F.try_variant_get("_json", f"$.{key}", "variant")


def _text(key: str) -> Column:
    return F.try_variant_get("_json", f"$.{key}", "string")


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _reason() -> Column:
    missing = F.lit(False)
    for key in KEYS:
        missing = missing | _part(key).isNull()
    return (
        F.when(F.col("_json").isNull(), "bad_json")
        .when(~_kind(F.col("_json")).startswith("OBJECT"), "not_object")
        .when(missing, "missing_key")
        .when(_kind(_part("news_article")) != "STRING", "bad_type")
    )


def checked(messages: DataFrame) -> DataFrame:
    """Messages with their fields and ``reason``: why it is refused, null if accepted.

    A key set to null counts as present; the article must be a string, since its
    line breaks are removed. The verdict leaves through a generator of one row, so
    that a later filter on it is not pushed down into a second parse of the text.
    """
    parsed = messages.withColumn("_json", F.try_parse_json("value"))
    verdict = F.struct(
        _reason().alias("reason"),
        _text("news_time").alias("news_time"),
        _text("news_title").alias("news_title"),
        S.strip_newlines(_text("news_article")).alias("news_article"),
    )
    judged = parsed.select(*messages.columns, F.array(verdict).alias("_verdict"))
    return judged.select(*messages.columns, F.inline_outer("_verdict"))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNull()).drop("value", "reason")


def refused(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNotNull()).drop(*KEYS)


def clean_news(messages: DataFrame) -> DataFrame:
    """Accepted messages as news rows, line breaks removed from the article.

    The same function serves batch and stream.
    """
    return accepted(checked(messages))


def dead_letters(messages: DataFrame) -> DataFrame:
    """Refused messages as they came, with the reason."""
    return refused(checked(messages))


def payload(df: DataFrame) -> DataFrame:
    """Rows as JSON messages, null fields kept."""
    return df.select(
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")
    )
