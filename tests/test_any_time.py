"""As-of and interval joins at any time, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bellwire.operators import asof as A

START = dt.datetime(2024, 1, 1)


def moment(seconds):
    return START + dt.timedelta(seconds=seconds)


def made(spark, seed=1, hot=0.4):
    """News and ticks of a hot symbol and some others, with equal instants, gaps, and rows without a key or time."""
    rng = random.Random(seed)
    pick = lambda: "hot" if rng.random() < hot else f"s{rng.randrange(6)}"
    news = [(i, pick(), moment(rng.randrange(0, 40_000, 5))) for i in range(700)]
    news += [(900, None, moment(1)), (901, "hot", None), (902, "unknown", moment(9)), (903, "hot", moment(-10**6)), (904, "hot", moment(10**6))]
    news += [(905, "hot", moment(50))] * 2
    ticks = [(pick(), moment(rng.randrange(0, 40_000, 5)), rng.randrange(100) / 4) for _ in range(900)]
    ticks += [(None, moment(3), 1.0), ("hot", None, 2.0), ("s1", moment(50), None)]
    return (
        news, ticks,
        spark.createDataFrame(news, "id INT, symbol STRING, at TIMESTAMP_NTZ").repartition(3),
        spark.createDataFrame(ticks, "symbol STRING, tick_at TIMESTAMP_NTZ, value DOUBLE").repartition(5),
    )


@pytest.mark.parametrize("strict, seconds, group_rows", [(True, 3600, 1 << 18), (False, 3600, 40), (True, 60, 2), (True, 10**7, 13)])
def test_asof(spark, strict, seconds, group_rows):
    news, ticks, left, right = made(spark)
    got = A.asof_rows(left, right, "symbol", "at", "tick_at", ["tick_at", "value"], seconds, strict, group_rows)
    assert got.columns == ["id", "symbol", "at", "tick_at", "value"]

    def last(symbol, at):
        if symbol is None or at is None:
            return None, None
        before = [(t, v is not None, v) for s, t, v in ticks if s == symbol and t is not None and (t < at or t == at and not strict)]
        return max(before)[::2] if before else (None, None)

    want = [(*row, *last(*row[1:])) for row in news if None not in row]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(news)
    assert sorted(map(str, (r for r in rows if None not in r[:3]))) == sorted(map(str, want))
    assert all(r[3:] == (None, None) for r in rows if None in r[:3])


def test_asof_empty_sides(spark):
    _, _, left, right = made(spark)
    nothing = A.asof_rows(left, right.where("false"), "symbol", "at", "tick_at", ["value"])
    assert nothing.count() == left.count() and nothing.where("value IS NOT NULL").count() == 0
    assert A.asof_rows(left.where("false"), right, "symbol", "at", "tick_at", ["value"]).count() == 0


def test_hot_bucket_is_dealt(spark):
    """The windows of one symbol and bucket hold no more than a few of its rows."""
    left = spark.range(3000).select(F.lit("hot").alias("symbol"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 600).cast("timestamp_ntz").alias("at"), "id")
    right = spark.createDataFrame([("hot", moment(30), 1.0)], "symbol STRING, tick_at TIMESTAMP_NTZ, value DOUBLE")
    joined = A.asof_rows(left, right, "symbol", "at", "tick_at", ["value"], group_rows=100)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_deal" in plan
    assert joined.where("value = 1.0").count() == left.where("id % 600 > 30").count()


@pytest.mark.parametrize("seconds", [60, 10**7])
def test_intervals(spark, seconds):
    news, ticks, left, right = made(spark)
    length = {i: (i * 37) % 7000 - 50 for i, _, _ in news}
    asked = left.withColumn("until", F.col("at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), ((F.col("id") * 37) % 7000 - 50).cast("decimal(18,6)")))
    pairs = A.interval_pairs(asked, right, "symbol", "at", "until", "tick_at", seconds)
    want = sorted(
        (i, s, t) for i, s, at in news for key, t, _ in ticks
        if s is not None and s == key and at is not None and t is not None and at <= t < at + dt.timedelta(seconds=length[i])
    )
    assert sorted((r["id"], r["symbol"], r["tick_at"]) for r in pairs.collect()) == want and len(want) > 1000
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    stats = A.interval_stats(asked, right, "symbol", "at", "until", "tick_at", "value", ["id"], seconds)
    rows = {r["id"]: r for r in stats.collect()}
    assert stats.count() == len(news) and rows[902]["n"] == 0 and rows[902]["first"] is None
    for i, _, _ in news:
        if i < 900:
            mine = [t for j, _, t in want if j == i]
            assert rows[i]["n"] == len(mine)
            values = [v for s, t, v in ticks if mine and s == rows[i]["symbol"] and t == min(mine)]
            assert not mine or rows[i]["first"] == min(values, key=lambda v: (v is not None, v))
