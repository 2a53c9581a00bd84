"""Good, bad or neutral news, from the price move that follows it.

Both labels are functions of ``(symbol, first midnight)``, so they are computed on
the bars and met by the news with one equi-join. Days whose label is the default
are left out of the day table: an unmatched news item is neutral. The table is stored and
measured first. If it is small it is broadcast and news is not shuffled at all; if not, both
sides are shuffled by symbol and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bellwire.functions import scalars as S
from bellwire.operators import asof as A
from bellwire.operators import bars as B
from bellwire.session import small_side


def _label_days(bars: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """``(symbol, day, label_<k>...)`` for days on which some label is not neutral."""
    stats = B.expanding_volatility(bars)
    first = F.lead("close", 1).over(B.by_date())
    two_ahead = F.lead("close", 2).over(B.by_date()).isNotNull()
    payload = {"_mean": F.col("mean_return"), "_std": F.col("std_pop"), "_first": first}
    for k in horizons:
        payload[f"_last_{k}"] = F.when(two_ahead, B.forward_close(k + 1))
    # The day before the explode: label each bar's interval once, not each day.
    held = stats.select(
        "symbol",
        "date",
        F.lead("date").over(B.by_date()).alias("_next"),
        *[column.alias(name) for name, column in payload.items()],
    )
    labelled = held.select(
        "symbol",
        "date",
        "_next",
        *[
            S.three_way_label(
                S.log_ratio(F.col(f"_last_{k}"), F.col("_first")), F.col("_mean"), F.col("_std")
            ).alias(f"label_{k}")
            for k in horizons
        ],
    )
    telling = F.lit(False)
    for k in horizons:
        telling = telling | (F.col(f"label_{k}") != "neutral")
    return (
        labelled.where(telling & F.col("_next").isNotNull())
        .withColumn("day", F.explode(F.sequence(F.date_add("date", 1), F.col("_next"))))
        .drop("date", "_next")
    )


def label_news(
    news: DataFrame, bars: DataFrame, horizon: int = B.DEFAULT_HORIZON
) -> DataFrame:
    """Three-way label: next ``horizon`` trading rows against mean and population deviation."""
    table = _label_days(bars, (horizon,)).withColumnRenamed(f"label_{horizon}", "label")
    return (
        A.news_days(news)
        .join(small_side(table), ["symbol", "day"], "left")
        .withColumn("label", F.coalesce("label", F.lit("neutral")))
        .drop("day")
    )


def label_news_horizons(
    news: DataFrame, bars: DataFrame, horizons: tuple[int, ...] = B.HORIZONS
) -> DataFrame:
    """One row per news item and horizon; the horizons share one join."""
    table = _label_days(bars, horizons)
    joined = A.news_days(news).join(small_side(table), ["symbol", "day"], "left").drop("day")
    fanned = F.array(
        *[
            F.struct(
                F.lit(k).alias("horizon"),
                F.coalesce(F.col(f"label_{k}"), F.lit("neutral")).alias("label"),
            )
            for k in horizons
        ]
    )
    return joined.select(*news.columns, F.inline(fanned))


def label_news_calendar(
    news: DataFrame, bars: DataFrame, days: int = B.DEFAULT_HORIZON
) -> DataFrame:
    """Binary label: next ``days`` calendar days against mean and sample deviation."""
    move = F.when(
        (F.col("history") >= 2) & (F.col("bars_ahead") >= 2),
        S.log_ratio(F.col("last_close"), F.col("first_close")),
    )
    table = (
        A.range_days(bars, days)
        .select(
            "symbol",
            "day",
            S.binary_label(move, F.col("mean_return"), F.col("std_samp")).alias("label"),
        )
        .where("label = 1")
    )
    return (
        A.news_days(news)
        .join(small_side(table), ["symbol", "day"], "left")
        .withColumn("label", F.coalesce("label", F.lit(0)))
        .drop("day")
    )
