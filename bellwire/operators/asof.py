"""News against bars: as-of, forward-k and calendar-range joins; rows against ticks at any time.

Bars are stamped at midnight, so everything a news item sees of its symbol
depends on the symbol and on ``first_midnight(news_time)`` alone. Each join is
therefore computed once per symbol and calendar day, on the bars, and news meets
it with one equi-join on ``(symbol, day)``:

* news is never sorted or windowed, and is shuffled at most once;
* a hot symbol spreads over its days, and adaptive execution splits what is
  still skewed, since news is the streamed side of a left join;
* the day table is bounded by symbols x calendar days, not by the news; measured to be
  small it is broadcast, and news isn't shuffled at all.

Ticks have any time. ``asof_rows`` and ``interval_pairs`` cut time into buckets of a fixed width, so that
a symbol spreads over its buckets, and carry what came before into each one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bellwire.functions import scalars as S
from bellwire.operators import bars as B
from bellwire.session import small_side, stored


def news_days(news: DataFrame) -> DataFrame:
    """News with ``day``, the first midnight not before ``news_time``."""
    return news.withColumn("day", S.first_midnight(F.col("news_time")))


def bar_days(bars: DataFrame, payload: dict) -> DataFrame:
    """One row per symbol and day between two bars, with values of the bar before.

    Bar ``i`` covers the days after it up to and including the next bar's date;
    the last bar covers one day. ``payload`` maps names to window expressions.
    """
    held = bars.select(
        "symbol",
        "date",
        F.lead("date").over(B.by_date()).alias("_next"),
        *[column.alias(name) for name, column in payload.items()],
    )
    first = F.date_add("date", 1)
    last = F.coalesce(F.col("_next"), first)
    return held.withColumn("day", F.explode(F.sequence(first, last))).drop("_next")


def asof_last_bar(news: DataFrame, bars: DataFrame) -> DataFrame:
    """Each news item with the last bar dated strictly before it, if any.

    News after the last bar takes that bar from one row per symbol, so its days stay
    spread. News without a time has no bar.
    """
    values = {"bar_date": "date", "bar_close": "close", "history": "idx"}
    table = small_side(
        bar_days(B.log_returns(bars), {name: F.col(c) for name, c in values.items()}).drop("date")
    )
    ends = small_side(table.groupBy("symbol").agg(F.max(F.struct(*values)).alias("_last")))
    after = F.col("day") > F.col("_last.bar_date")
    return (
        news_days(news)
        .join(table, ["symbol", "day"], "left")
        .join(ends, "symbol", "left")
        .withColumns({name: F.coalesce(name, F.when(after, F.col(f"_last.{name}"))) for name in values})
        .withColumn("history", F.coalesce("history", F.lit(0)).cast("bigint"))
        .drop("day", "_last")
    )


def forward_k_bars(
    news: DataFrame, bars: DataFrame, horizon: int = B.DEFAULT_HORIZON
) -> DataFrame:
    """Each news item with the first and the last of its next ``horizon + 1`` bars.

    A bar starts the future of every day after the bar before it. News before the first
    bar takes that bar's values from one row per symbol; news without a time has no future.
    """
    indexed = B.log_returns(bars)
    left = F.count("*").over(B.all_dates()) - F.col("idx") + 1
    starts = indexed.select(
        "symbol",
        "date",
        F.lag("date").over(B.by_date()).alias("_before"),
        F.col("close").alias("first_close"),
        B.forward_close(horizon).alias("last_close"),
        F.least(left, F.lit(horizon + 1)).alias("bars_ahead"),
    )
    since = F.coalesce(F.date_add("_before", 1), F.col("date"))
    table = small_side(
        starts.withColumn("day", F.explode(F.sequence(since, F.col("date")))).drop("_before", "date")
    )
    ahead = ["bars_ahead", "first_close", "last_close"]
    begins = small_side(table.groupBy("symbol").agg(F.min(F.struct("day", *ahead)).alias("_first")))
    before = F.col("day") < F.col("_first.day")
    return (
        news_days(news)
        .join(table, ["symbol", "day"], "left")
        .join(begins, "symbol", "left")
        .withColumns({c: F.coalesce(c, F.when(before, F.col(f"_first.{c}"))) for c in ahead})
        .withColumn("bars_ahead", F.coalesce("bars_ahead", F.lit(0)).cast("bigint"))
        .drop("day", "_first")
    )


def range_days(bars: DataFrame, days: int = B.DEFAULT_HORIZON) -> DataFrame:
    """Per symbol and day: bars within ``[day, day + days)`` and their first and last close.

    The day table starts ``days - 1`` before the first bar, has every day once, and
    carries the returns known before each day.
    """
    stats = B.expanding_volatility(bars)
    # Days up to and including each bar's date, from the day after the bar before.
    placed = stats.select(
        "symbol",
        "date",
        "close",
        F.coalesce(
            F.date_add(F.lag("date").over(B.by_date()), 1), F.date_sub("date", days - 1)
        ).alias("_since"),
        F.lag("idx").over(B.by_date()).alias("history"),
        F.lag("mean_return").over(B.by_date()).alias("mean_return"),
        F.lag("std_samp").over(B.by_date()).alias("std_samp"),
    )
    table = placed.withColumn("day", F.explode(F.sequence("_since", "date"))).withColumn(
        "_close", F.when(F.col("day") == F.col("date"), F.col("close"))
    )
    span = (
        Window.partitionBy("symbol").orderBy(F.unix_date("day")).rangeBetween(0, days - 1)
    )
    return table.select(
        "symbol",
        "day",
        F.coalesce("history", F.lit(0)).cast("bigint").alias("history"),
        "mean_return",
        "std_samp",
        F.count("_close").over(span).alias("bars_ahead"),
        F.first("_close", ignorenulls=True).over(span).alias("first_close"),
        F.last("_close", ignorenulls=True).over(span).alias("last_close"),
    )


def range_window_bars(
    news: DataFrame, bars: DataFrame, days: int = B.DEFAULT_HORIZON
) -> DataFrame:
    """Each news item with the bars dated in ``[news_time, news_time + days)``.

    The interval is half open and whole days long, so it holds the same dates
    for every news time between two midnights.
    """
    table = range_days(bars, days).select(
        "symbol", "day", "bars_ahead", "first_close", "last_close"
    )
    return (
        news_days(news)
        .join(table, ["symbol", "day"], "left")
        .withColumn("bars_ahead", F.coalesce("bars_ahead", F.lit(0)).cast("bigint"))
        .drop("day")
    )


# --- any time ------------------------------------------------------------------

# Seconds of a bucket, and rows of one symbol and bucket that one task takes.
BUCKET_SECONDS = 3600
GROUP_ROWS = 1 << 18


def bucket_of(time: Column, seconds: int) -> Column:
    """The number of the bucket that a wall-clock time falls in."""
    since = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), time.cast("timestamp_ntz"))
    return F.floor(since / (seconds * 1_000_000))


def asof_rows(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    payload: list[str],
    seconds: int = BUCKET_SECONDS,
    strict: bool = True,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Each row of ``left`` with ``payload`` of the last row of ``right`` of its key before its time.

    ``strict`` leaves out rows of the same instant; otherwise they count. Of right rows of one key and instant, the greatest
    payload counts. Rows that have nothing before them, no key or no time keep nulls. ``payload`` may hold
    ``right_time``; its names must not be those of ``left``.

    Both sides meet in windows of one key and bucket, ordered by time. The last row of all earlier buckets, one per
    key and bucket, is carried in. A key spreads over its buckets; one bucket with more than ``group_rows`` left
    rows is dealt to several windows, each of which sees all right rows of the bucket.
    """
    timed = F.col(key).isNotNull() & F.col(right_time).isNotNull()
    ticks = right.where(timed).groupBy(F.col(key).alias("_key"), F.col(right_time).alias("_time"))
    ticks = stored(ticks.agg(F.max(F.struct(*payload)).alias("_found")), "asof-ticks")
    ticks = ticks.withColumn("_bucket", bucket_of(F.col("_time"), seconds))
    rows = left.select(
        F.struct(*left.columns).alias("_row"), F.col(key).alias("_key"), F.col(left_time).alias("_time")
    ).withColumn("_bucket", bucket_of(F.col("_time"), seconds))
    asked = rows.where("_key IS NOT NULL AND _bucket IS NOT NULL")
    asked = asked.groupBy("_key", "_bucket").agg(F.count("*").alias("_n"))
    # One row per key and bucket: the bucket's last tick, and how many rows ask in it.
    marks = ticks.groupBy("_key", "_bucket").agg(F.max(F.struct("_time", "_found")).alias("_last"))
    marks = marks.unionByName(asked, allowMissingColumns=True)
    earlier = Window.partitionBy("_key").orderBy("_bucket").rangeBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier))
    deals = F.ceil(F.col("_n") / group_rows).cast("int")
    buckets = small_side(
        carried.where("_n IS NOT NULL").select("_key", "_bucket", F.col("_carry._found").alias("_carry"), deals.alias("_deals"))
    )
    # Rows without a key or time see nothing and are dealt evenly.
    deal = F.pmod(F.xxhash64("_row"), F.coalesce("_deals", F.lit(4096))).cast("int")
    dealt = rows.join(buckets, ["_key", "_bucket"], "left").withColumn("_deal", deal).drop("_deals")
    seen = ticks.join(buckets.drop("_carry"), ["_key", "_bucket"])
    seen = seen.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.col("_deals") - 1))).drop("_deals")
    both = dealt.withColumn("_tick", F.lit(0 if strict else 1)).unionByName(
        seen.withColumn("_tick", F.lit(1 if strict else 0)), allowMissingColumns=True
    )
    so_far = (
        Window.partitionBy("_key", "_bucket", "_deal")
        .orderBy("_time", "_tick")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    told = both.withColumn("_seen", F.coalesce(F.last("_found", ignorenulls=True).over(so_far), "_carry"))
    return told.where("_row IS NOT NULL").select(
        *[F.col(f"_row.{c}") for c in left.columns], *[F.col(f"_seen.{c}") for c in payload]
    )


def interval_pairs(
    left: DataFrame,
    right: DataFrame,
    key: str,
    start: str,
    end: str,
    time: str,
    seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Pairs of a left row and a right row of its key whose ``time`` lies in ``[start, end)``.

    An interval is put in each bucket that it touches; a right row is in one, so that a pair is found once. The join is
    on key and bucket, the interval is a condition of it. Buckets should be about as long as intervals. An interval that
    is empty or lacks a bound, and a row without a key or time, are in no pair. Left columns and right columns other than
    the key must differ in name.
    """
    # The last instant of an interval is one microsecond before its end.
    first = bucket_of(F.col(start), seconds)
    last = bucket_of(F.col(end).cast("timestamp_ntz") - F.expr("INTERVAL '0.000001' SECOND"), seconds)
    touched = left.where(F.col(start) < F.col(end)).withColumn("_bucket", F.explode(F.sequence(first, last)))
    placed = right.withColumn("_bucket", bucket_of(F.col(time), seconds))
    inside = (F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))
    return touched.join(placed, [key, "_bucket"]).where(inside).drop("_bucket")


def interval_stats(
    left: DataFrame,
    right: DataFrame,
    key: str,
    start: str,
    end: str,
    time: str,
    value: str,
    row: list[str],
    seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Each row of ``left`` with ``n`` right rows in its interval and the ``first`` and ``last`` of their values.

    ``row`` names the columns that tell left rows apart; pairs are added up per left row before they are
    shuffled. Rows without a pair have 0 and nulls; of values at one instant the least is first and the greatest last.
    """
    asked = left.select(*dict.fromkeys([*row, key, start, end])).distinct()
    ticks = right.select(key, F.col(time).alias("_time"), F.col(value).alias("_value"))
    pairs = interval_pairs(asked, ticks, key, start, end, "_time", seconds)
    stats = pairs.groupBy(*row).agg(
        F.count("*").alias("n"),
        F.min(F.struct("_time", "_value")).alias("_first"),
        F.max(F.struct("_time", "_value")).alias("_last"),
    )
    return left.join(stats, row, "left").select(
        *left.columns,
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        F.col("_first._value").alias("first"),
        F.col("_last._value").alias("last"),
    )
