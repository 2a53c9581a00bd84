"""Collection scans, paging, keyed updates, feeds and high-water marks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bellwire.session import settled, small_side

# Ids per page, page limit and items per feed of one load.
PAGE_IDS = 3000


def collection_scan(
    df: DataFrame,
    order: str | list[str],
    where: Column | None = None,
    keys: list[str] | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Filter, strict projection and row cap; an unknown key fails at analysis."""
    rows = df if where is None else df.where(where)
    if max_rows is not None:
        rows = rows.orderBy(order).limit(max_rows)
    return rows if keys is None else rows.select(*keys)


def paged_scan(
    df: DataFrame,
    tags: list[str],
    order: str | list[str],
    where: Column | None = None,
    skip: int = 0,
    limit: int | None = None,
    after: Column | None = None,
) -> DataFrame:
    """One page, projected leniently (an absent tag is null), then without its null rows.

    Without a ``limit`` all rows are read. ``skip`` sorts all rows before the page into one
    take; deep pages are read with ``after``, the last key of the page before (one order column).
    """
    rows = df if where is None else df.where(where)
    if after is not None:
        rows = rows.where(F.col(order) > after)
    page = rows
    if skip or limit is not None:
        page = page.orderBy(order).offset(skip)
    if limit is not None:
        page = page.limit(limit)
    have = [F.col(t) if t in df.columns else F.lit(None).alias(t) for t in tags]
    return page.select(*have).na.drop("any")


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All rows of several collections, their source named, absent fields null."""
    parts = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def regex_search(df: DataFrame, field: str, pattern: str) -> DataFrame:
    """Rows whose field contains a match; the parameter is a pattern, not a literal."""
    return df.where(F.col(field).rlike(pattern))


def members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a table of ids."""
    return df.join(ids.select(key), key, "left_semi")


def keyed_update(base: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """``base`` with the columns of ``patch`` set on matching keys.

    Values set to null stay null, rows without a patch stay as they are, and columns
    that only the patch has are added. Keys of the patch are unique.
    """
    fields = [c for c in patch.columns if c != key]
    side = patch.select(
        key, F.struct(*[F.col(c) for c in fields]).alias("_set")
    )
    joined = base.join(side, key, "left")
    found = F.col("_set").isNotNull()

    def value(name: str) -> Column:
        old = F.col(name) if name in base.columns else F.lit(None)
        return F.when(found, F.col(f"_set.{name}")).otherwise(old).alias(name)

    kept = [value(c) if c in fields else F.col(c) for c in base.columns]
    added = [value(c) for c in fields if c not in base.columns]
    return joined.select(*kept, *added)


def update_first(
    base: DataFrame, where: Column, values: dict[str, Column], key: str
) -> DataFrame:
    """Set values on the first row, by key, that meets a condition."""
    first = base.where(where).orderBy(key).limit(1)
    return keyed_update(base, first.select(key, *[c.alias(n) for n, c in values.items()]), key)


def distinct_values(df: DataFrame, tags: list[str]) -> DataFrame:
    """``(tag, value)``: distinct values of several fields in one pass."""
    pairs = F.array(
        *[F.struct(F.lit(t).alias("tag"), F.col(t).cast("string").alias("value")) for t in tags]
    )
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()


def global_row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its 1-based position in a total order, without a one-task window.

    A distributed sort is stored once, so its partitions are fixed; positions are
    the place within the partition plus the rows of the partitions before it.
    Only one row per partition is ever brought together.
    """
    placed = settled(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftrightunsigned("_at", 33)
    within = F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.withColumn("_part", part)
        # One row per partition of the sort: bounded by the number of tasks.
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + within + 1)
        .drop("_at", "_part", "_offset")
    )


def page_numbers(df: DataFrame, key: str, size: int = PAGE_IDS) -> DataFrame:
    """The page of each row when a whole collection is read in pages of ``size``."""
    numbered = global_row_number(df, [F.col(key)], "_row")
    return numbered.withColumn("page", F.floor((F.col("_row") - 1) / size)).drop("_row")


def feed_cutoff(
    items: DataFrame,
    feed: str,
    position: str,
    time: str,
    latest: Column,
) -> DataFrame:
    """Items of newest-first feeds up to, not including, the first that is already known.

    An item is known if its time is not empty and not after ``latest``. The stop
    position is one partially aggregated row per feed, so no feed is ever windowed.
    """
    known = (F.col(time) != "") & (F.col(time) <= latest)
    stops = small_side(
        items.where(known).groupBy(feed).agg(F.min(position).alias("_stop"))
    )
    return (
        items.join(stops, feed, "left")
        .where(F.col("_stop").isNull() | (F.col(position) < F.col("_stop")))
        .drop("_stop")
    )


def feed_cap(
    items: DataFrame,
    feed: str,
    order: list[Column],
    cap: int,
    shards: tuple[int, ...] = (1024, 32, 1),
) -> DataFrame:
    """The first ``cap`` items of each feed.

    Each shard of a feed keeps its own first ``cap`` rows before fewer, then one,
    see them: the first round splits a hot feed over all tasks, and later windows
    hold at most 32 times ``cap`` rows of it.
    """
    place = F.xxhash64(*items.columns)
    kept = items
    for count in shards:
        window = Window.partitionBy(feed, "_shard").orderBy(*order)
        kept = (
            kept.withColumn("_shard", F.pmod(place, F.lit(count)))
            .withColumn("_rank", F.row_number().over(window))
            .where(F.col("_rank") <= cap)
            .drop("_rank", "_shard")
        )
    return kept


def feed_high_water(items: DataFrame, feed: str, position: str, time: str) -> DataFrame:
    """Time of the first dated item of each newest-first feed."""
    return (
        items.where(F.col(time) != "")
        .groupBy(feed)
        .agg(F.min_by(time, position).alias("latest"))
    )


def min_count_gate(df: DataFrame, key: str, minimum: int) -> DataFrame:
    """Rows of keys with at least ``minimum`` rows."""
    enough = small_side(
        df.groupBy(key).count().where(F.col("count") >= minimum).select(key)
    )
    return df.join(enough, key, "left_semi")
