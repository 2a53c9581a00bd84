"""Daily bars: building, returns, volatility and forward moves.

A bar table holds at most one row per symbol and date, so a window over one
symbol is bounded by the trading calendar however many ticks or articles that
symbol has. Nothing unbounded is ever put in a per-symbol window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from bellwire.functions import scalars as S
from bellwire.session import small_side

# Horizons in trading days, and the default one.
HORIZONS = (3, 5, 10, 15, 30, 60)
DEFAULT_HORIZON = 15
# Fixed value: symbols without any stored bar load from here on.


def by_date() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")


def all_dates() -> WindowSpec:
    return by_date().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def so_far() -> WindowSpec:
    return by_date().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def bars_from_ticks(
    ticks: DataFrame, symbol: Column, moment: Column, price: Column, order: Column, volume: Column
) -> DataFrame:
    """Open/high/low/close/volume per symbol and day; partial aggregation absorbs hot symbols."""
    return ticks.groupBy(symbol.alias("symbol"), moment.cast("date").alias("date")).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        volume.cast("double").alias("volume"),
    )


def usable_bars(bars: DataFrame) -> DataFrame:
    """Bars whose close is a positive number."""
    return bars.where(F.col("close").isNotNull() & ~F.isnan("close") & (F.col("close") > 0))


def valid_bars(bars: DataFrame) -> DataFrame:
    """Bars with a usable close, one per symbol and date."""
    in_order = Window.partitionBy("symbol").orderBy("date", "close")
    marked = usable_bars(bars).withColumn("_before", F.lag("date").over(in_order))
    return marked.where(~F.col("date").eqNullSafe(F.col("_before"))).drop("_before")


def log_returns(bars: DataFrame) -> DataFrame:
    """Valid bars with their position ``idx`` and the log return from the bar before."""
    return (
        valid_bars(bars)
        .withColumn("idx", F.row_number().over(by_date()).cast("bigint"))
        .withColumn("log_return", S.log_ratio(F.col("close"), F.lag("close").over(by_date())))
    )


def expanding_volatility(bars: DataFrame) -> DataFrame:
    """Mean, population and sample deviation of all returns up to each bar."""
    return (
        log_returns(bars)
        .withColumn("mean_return", F.avg("log_return").over(so_far()))
        .withColumn("std_pop", F.stddev_pop("log_return").over(so_far()))
        .withColumn("std_samp", F.stddev_samp("log_return").over(so_far()))
    )


def forward_close(horizon: int) -> Column:
    """Close ``horizon`` bars ahead, or the last one there is."""
    return F.coalesce(F.lead("close", horizon).over(by_date()), F.last("close").over(all_dates()))


def forward_return_rows(bars: DataFrame, horizon: int = DEFAULT_HORIZON) -> DataFrame:
    """Log return over the next ``horizon`` bars; null on the last bar."""
    ahead = log_returns(bars).withColumn("last_close", forward_close(horizon))
    return ahead.withColumn(
        "forward_return",
        F.when(
            F.lead("close", 1).over(by_date()).isNotNull(),
            S.log_ratio(F.col("last_close"), F.col("close")),
        ),
    )


def forward_return_range(bars: DataFrame, days: int = DEFAULT_HORIZON) -> DataFrame:
    """Log return from each bar to the last one within ``days`` calendar days."""
    span = (
        Window.partitionBy("symbol").orderBy(F.unix_date("date")).rangeBetween(0, days - 1)
    )
    return (
        log_returns(bars)
        .withColumn("bars_ahead", F.count("close").over(span))
        .withColumn("last_close", F.last("close").over(span))
        .withColumn(
            "forward_return",
            F.when(
                F.col("bars_ahead") >= 2,
                S.log_ratio(F.col("last_close"), F.col("close")),
            ),
        )
    )


def bar_features(bars: DataFrame) -> DataFrame:
    return bars.withColumn("price_range", S.price_range(F.col("high"), F.col("low"))).withColumn(
        "price_change_percentage", S.price_change(F.col("open"), F.col("close"))
    )


def calendar_parts(bars: DataFrame) -> DataFrame:
    return (
        bars.withColumn("year", F.year("date"))
        .withColumn("month", F.month("date"))
        .withColumn("day", F.dayofmonth("date"))
    )


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as ``(x - mean) / sample deviation``; a constant column becomes 0.

    The statistics are one row, read as scalar subqueries of the same plan.
    """
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_samp(c).alias(f"{c}_std") for c in columns],
        ).alias("stats")
    ).scalar()
    held = df.withColumn("_stats", stats)
    scaled = [
        F.coalesce(
            F.try_divide(F.col(c) - F.col(f"_stats.{c}_mean"), F.col(f"_stats.{c}_std")),
            F.when(F.col(c).isNotNull(), 0.0),
        ).alias(c)
        for c in columns
    ]
    rest = [c for c in df.columns if c not in columns]
    return held.select(*rest, *scaled)


def after_close_ticks(ticks: DataFrame, close: str = S.MARKET_CLOSE) -> DataFrame:
    """First tick per symbol and day at or after the close."""
    return (
        ticks.where(S.at_or_after_close(F.col("ts"), close))
        .groupBy("symbol", F.to_date("ts").alias("date"))
        .agg(F.min("ts").alias("ts"), F.min_by("value", "ts").alias("value"))
    )


def first_per_day(ticks: DataFrame) -> DataFrame:
    """Once-a-day guard: the first record of each symbol and day, and how many were dropped."""
    return ticks.groupBy("symbol", F.to_date("ts").alias("date")).agg(
        F.min_by("value", "ts").alias("value"), (F.count("*") - 1).alias("dropped")
    )


def snapshot_to_bar(snapshot: DataFrame, day: Column) -> DataFrame:
    """A market snapshot as the bar of ``day``: the last trade is the close."""
    return snapshot.select(
        "symbol",
        day.cast("date").alias("date"),
        "open",
        "high",
        "low",
        F.col("trade").alias("close"),
        "volume",
    )


def stock_dimension(snapshot: DataFrame) -> DataFrame:
    return snapshot.select("name", "symbol").distinct()


def latest_dates(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(F.max("date").alias("latest"))


def incremental_bars(
    incoming: DataFrame, stored: DataFrame, today: Column, default_start: str | None = None
) -> DataFrame:
    """Incoming bars newer than the stored ones of the same symbol.

    A symbol whose stored bars reach the weekday before ``today`` is skipped. One without
    stored bars gives all of its bars, or those after ``default_start``.
    The marks are one row per symbol and broadcast only if measured small.
    """
    marks = small_side(latest_dates(stored))
    start = F.coalesce(F.col("latest"), F.lit(default_start).cast("date"))
    open_ = start.isNull() | ((start < S.recent_weekday(today)) & (F.col("date") > start))
    return (
        incoming.join(marks, "symbol", "left")
        .where(open_)
        .drop("latest")
    )
