"""Which stocks an article mentions, and what is done with that."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bellwire.functions import scalars as S
from bellwire.functions import text as T
from bellwire.operators import labels as L
from bellwire.operators.scans import keyed_update
from bellwire.session import small_side

# Fixed value: shorter words are never stock names.
MIN_NAME_CHARS = 3


def symbol_lookup(listings: DataFrame) -> DataFrame:
    """``(name, symbol)`` with one symbol per name: the last one loaded."""
    return listings.groupBy("name").agg(F.max_by("symbol", "load_order").alias("symbol"))


def token_symbols(tokens: DataFrame, names: DataFrame) -> DataFrame:
    """Token rows that equal a stock name, with its symbol."""
    return tokens.join(names.withColumnRenamed("name", "token"), "token")


def article_words(
    articles: DataFrame,
    keep: list[str],
    title: str | None,
    article: str,
    tokenizer: Callable[[Column], Column] = T.tokens,
) -> DataFrame:
    """``(*keep, token)``: distinct candidate words of each article.

    Words are split, measured and made distinct inside the row. ``tokenizer`` turns a
    text into its words; Chinese text needs one that knows the names.
    """
    text = S.title_and_article(F.col(title), F.col(article)) if title else F.col(article)
    words = T.longer_tokens(tokenizer(text), MIN_NAME_CHARS)
    return T.token_rows(
        articles.select(*keep, F.array_distinct(words).alias("_words")), "_words", *keep
    )


def mention_hits(
    articles: DataFrame,
    names: DataFrame,
    stop_words: DataFrame,
    keep: list[str],
    title: str | None = "news_title",
    article: str = "news_article",
    tokenizer: Callable[[Column], Column] = T.tokens,
) -> DataFrame:
    """``(*keep, symbol)`` for every name an article has; two names may share a symbol.

    Stop words are taken out of the names, not out of the text: the result is the
    same, and the text meets one join instead of two. What is left of the names is
    measured and broadcast if small; the far larger text is then not shuffled.
    """
    wanted = small_side(
        names.join(stop_words.withColumnRenamed("word", "name"), "name", "left_anti")
    )
    hits = token_symbols(article_words(articles, keep, title, article, tokenizer), wanted)
    return hits.select(*keep, "symbol")


def relevant_symbols(hits: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per article with a hit: its distinct codes as an array, in order."""
    return hits.groupBy(key).agg(
        F.sort_array(F.collect_set("symbol")).alias("relevant_symbols")
    )


def joined_codes(symbols: Column) -> Column:
    return F.array_join(symbols, " ")


def link_writeback(
    articles: DataFrame, linked: DataFrame, key: str = "doc_id"
) -> DataFrame:
    """Articles with their codes set; those without a hit are left as they are."""
    return keyed_update(articles, linked, key)


def news_for_symbol(linked: DataFrame, symbol: str) -> DataFrame:
    """Articles linked to one symbol."""
    return linked.where(F.array_contains("relevant_symbols", symbol))


def news_for_code_text(linked: DataFrame, code: str) -> DataFrame:
    """Articles whose joined codes contain a text, which may be part of a code."""
    return linked.where(joined_codes(F.col("relevant_symbols")).contains(code))


def symbol_fanout(linked: DataFrame) -> DataFrame:
    """One row per article and linked symbol."""
    return linked.withColumn("symbol", F.explode("relevant_symbols")).drop("relevant_symbols")


def labelled_export(
    articles: DataFrame, hits: DataFrame, bars: DataFrame, key: str = "doc_id"
) -> DataFrame:
    """Labelled articles for all symbols at once, from ``(key, news_time, symbol)`` hits.

    Labels are found on the narrow rows; the texts meet only the finished labels.
    """
    labelled = L.label_news(hits.distinct(), bars).select(key, "symbol", "label")
    return articles.join(labelled, key)
