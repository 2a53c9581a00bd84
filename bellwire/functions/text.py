"""Tokenising and counting inside one row, on the JVM.

A document is one row, so its tokens are split, filtered and counted there,
before anything is exploded: bag-of-words needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: everything but letters and digits separates words.
SEPARATOR = r"[^\p{L}\p{N}]+"


def tokens(text: Column, lower: bool = True) -> Column:
    """Words of a text in a spaced script, in order, blanks removed."""
    source = F.lower(text) if lower else text
    return F.array_remove(F.split(source, SEPARATOR), "")


def longer_tokens(words: Column, min_chars: int = 3) -> Column:
    return F.filter(words, lambda w: F.char_length(w) >= min_chars)


def token_counts(df: DataFrame, words: str, *keys: str) -> DataFrame:
    """``(*keys, token, tf)`` from the array column ``words``, without a shuffle.

    Words are sorted and each run of equal words becomes one entry, so a long
    document costs n log n and never leaves its row. The steps are separate
    projections because a column used inside a lambda is evaluated once per
    element if it is not already materialised.
    """
    empty = F.array().cast("array<int>")
    ordered = df.select(*keys, F.sort_array(F.col(words)).alias("_ordered"))
    started = ordered.select(
        *keys,
        "_ordered",
        F.filter(
            F.when(F.size("_ordered") > 0, F.sequence(F.lit(0), F.size("_ordered") - 1)).otherwise(empty),
            lambda i: (i == 0) | (F.get("_ordered", i) != F.get("_ordered", i - 1)),
        ).alias("_starts"),
    )
    counted = started.select(
        *keys,
        F.transform(
            "_starts",
            lambda start, j: F.struct(
                F.get("_ordered", start).alias("token"),
                (F.coalesce(F.get("_starts", j + 1), F.size("_ordered")) - start)
                .cast("bigint")
                .alias("tf"),
            ),
        ).alias("_counts"),
    )
    return outer_rows(counted.select(*keys, F.inline_outer("_counts")), "token")


def outer_rows(exploded: DataFrame, column: str) -> DataFrame:
    """Rows of an ``*_outer`` generator, without those of empty arrays.

    The plain generators make the optimizer infer ``size(array) > 0`` below
    them, which repeats the whole expression that builds the array.
    """
    return exploded.where(F.col(column).isNotNull())


def token_rows(df: DataFrame, words: str, *keys: str) -> DataFrame:
    """``(*keys, token)``: one row per element of the array column ``words``."""
    return outer_rows(df.select(*keys, F.explode_outer(words).alias("token")), "token")
