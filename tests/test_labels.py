"""Labels and joins of news with bars, against plain loops and hand-built cases."""

import math
import random
from datetime import date, datetime, timedelta
from statistics import mean, pstdev, stdev

import pytest
from pyspark.sql import functions as F

from bellwire import session
from bellwire.operators import asof as A
from bellwire.operators import bars as B
from bellwire.operators import labels as L

BARS = "symbol STRING, date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"
NEWS = "news_id BIGINT, news_time TIMESTAMP_NTZ, symbol STRING"
DAY0 = date(2024, 11, 1)


def bar_frame(spark, closes):
    """Bars from ``{symbol: [(day, close)]}``."""
    rows = [(s, d, c, c, c, c, 1.0) for s, days in closes.items() for d, c in days]
    return spark.createDataFrame(rows, BARS)


def daily(*closes):
    return [(DAY0 + timedelta(days=i), c) for i, c in enumerate(closes)]


def midnight(day):
    return datetime(day.year, day.month, day.day)


def split(days, moment):
    """Bars before and from a moment, one per date, usable closes only."""
    usable, seen = [], set()
    for day, close in sorted(days, key=lambda x: (x[0], x[1] if x[1] is not None else 0)):
        if close is not None and not math.isnan(close) and close > 0 and day not in seen:
            seen.add(day)
            usable.append((day, close))
    before = [b for b in usable if midnight(b[0]) < moment]
    after = [b for b in usable if midnight(b[0]) >= moment]
    return before, after


def returns(bars):
    return [math.log(b[1] / a[1]) for a, b in zip(bars, bars[1:])]


def plain_label(days, moment, horizon):
    before, after = split(days, moment)
    after = after[: horizon + 1]
    if len(after) < 2 or len(before) < 2:
        return "neutral"
    r, rs = math.log(after[-1][1] / after[0][1]), returns(before)
    if r > mean(rs) + pstdev(rs):
        return "good"
    return "bad" if r < mean(rs) - pstdev(rs) else "neutral"


def plain_calendar(days, moment, term):
    before, after = split(days, moment)
    after = [b for b in after if midnight(b[0]) < moment + timedelta(days=term)]
    if len(before) < 3 or len(after) < 2:
        return 0
    r, rs = math.log(after[-1][1] / after[0][1]), returns(before)
    return int(r > mean(rs) + stdev(rs))


@pytest.fixture(scope="module")
def market():
    """Random symbols with gaps, unusable closes and repeated dates, and news all around them."""
    rng = random.Random(7)
    closes = {"none": []}
    for s in range(12):
        days = []
        for i in range(60):
            if rng.random() < (0.35 if s % 3 else 0.05):
                continue
            close = round(math.exp(rng.gauss(2, 0.2)), 2)
            if rng.random() < 0.05:
                close = rng.choice([0.0, -1.0, None, float("nan")])
            days.append((DAY0 + timedelta(days=i), close))
            if close and rng.random() < 0.05:
                days.append((DAY0 + timedelta(days=i), close))
        closes[f"s{s}"] = days[: rng.choice([0, 1, 2, 3, 60, 60, 60])]
    closes["s0"] = closes["s0"] or daily(1.0, 2.0, 1.5, 3.0)
    news, at = [], 0
    for s in [*closes, "unknown"]:
        for _ in range(60):
            moment = midnight(DAY0) + timedelta(minutes=rng.randrange(-30 * 1440, 100 * 1440))
            if rng.random() < 0.4:
                moment = moment.replace(hour=0, minute=0)
            news.append((at, moment, s))
            at += 1
    return {**closes, "unknown": []}, news


def collected(df, *columns):
    return {r["news_id"]: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("horizon", [1, 3, 15])
def test_label_equals_loop(spark, market, horizon):
    closes, news = market
    got = collected(
        L.label_news(spark.createDataFrame(news, NEWS), bar_frame(spark, closes), horizon), "label"
    )
    assert got == {i: (plain_label(closes[s], t, horizon),) for i, t, s in news}
    assert len(set(got.values())) == 3


def test_horizons_equal_single_labels(spark, market):
    closes, news = market
    got = L.label_news_horizons(spark.createDataFrame(news, NEWS), bar_frame(spark, closes))
    rows = {(r["news_id"], r["horizon"]): r["label"] for r in got.collect()}
    assert rows == {
        (i, k): plain_label(closes[s], t, k) for i, t, s in news for k in B.HORIZONS
    }


@pytest.mark.parametrize("term", [2, 15])
def test_calendar_label_equals_loop(spark, market, term):
    closes, news = market
    got = collected(
        L.label_news_calendar(spark.createDataFrame(news, NEWS), bar_frame(spark, closes), term),
        "label",
    )
    assert got == {i: (plain_calendar(closes[s], t, term),) for i, t, s in news}
    assert len(set(got.values())) == 2


def test_joins_equal_loops(spark, market):
    closes, news = market
    frame, bars = spark.createDataFrame(news, NEWS), bar_frame(spark, closes)
    last = collected(A.asof_last_bar(frame, bars), "bar_date", "bar_close", "history")
    ahead = collected(A.forward_k_bars(frame, bars, 4), "first_close", "last_close", "bars_ahead")
    within = collected(
        A.range_window_bars(frame, bars, 10), "first_close", "last_close", "bars_ahead"
    )
    for i, t, s in news:
        before, after = split(closes[s], t)
        assert last[i] == ((*before[-1], len(before)) if before else (None, None, 0)), (i, t, s)
        some = after[:5]
        assert ahead[i] == ((some[0][1], some[-1][1], len(some)) if some else (None, None, 0))
        some = [b for b in after if midnight(b[0]) < t + timedelta(days=10)]
        assert within[i] == ((some[0][1], some[-1][1], len(some)) if some else (None, None, 0))


def label_of(spark, days, moment, horizon=15):
    news = spark.createDataFrame([(0, moment, "a")], NEWS)
    return L.label_news(news, bar_frame(spark, {"a": days}), horizon).first()["label"]


def test_bar_of_the_news_day(spark):
    """The bar of the day is history, unless the news is stamped at midnight."""
    days = daily(1.0, 1.01, 1.0, 1.01, 5.0)
    day = DAY0 + timedelta(days=3)
    assert label_of(spark, days, midnight(day)) == "good"  # 1.01 to 5
    assert label_of(spark, days, midnight(day) + timedelta(hours=15)) == "neutral"  # only 5


@pytest.mark.parametrize("history", [0, 1])
def test_too_little_history(spark, history):
    days = daily(*[1.0] * history, 1.0, 9.0)
    assert label_of(spark, days, midnight(DAY0 + timedelta(days=history))) == "neutral"


def test_two_bars_of_history(spark):
    """One return: deviation 0 for the first label, unknown for the second."""
    days = daily(1.0, 1.1, 1.0, 2.0)
    moment = midnight(DAY0 + timedelta(days=2))
    assert label_of(spark, days, moment) == "good"
    news = spark.createDataFrame([(0, moment, "a")], NEWS)
    bars = bar_frame(spark, {"a": days})
    assert L.label_news_calendar(news, bars).first()["label"] == 0


def test_horizon_uses_row_k_plus_one(spark):
    """20 bars ahead and horizon 15: the 16th counts."""
    ahead = [1.0] * 15 + [9.0] + [1.0] * 4
    days = daily(1.0, 1.01, 1.0, *ahead)
    assert label_of(spark, days, midnight(DAY0 + timedelta(days=3))) == "good"
    assert label_of(spark, days, midnight(DAY0 + timedelta(days=3)), 14) == "neutral"


SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
}


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """No side is small enough, and partitions count as skewed early."""
    before = {k: spark.conf.get(k, None) for k in SKEWED}
    for k, v in SKEWED.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", 0)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_symbol_is_split(spark, no_broadcast):
    """A third of the news on one symbol and day: its partition is split, nothing is lost."""
    days = daily(1.0, 1.01, 1.0, 1.01, 5.0)
    bars = bar_frame(spark, {f"s{i}": days for i in range(50)})
    at = "TIMESTAMP_NTZ'2024-11-04 00:00:00'"
    symbol = "IF(id % 3 = 0, 's0', concat('s', id % 50))"
    news = spark.range(300_000, numPartitions=16).selectExpr(
        "id AS news_id", f"{at} AS news_time", f"{symbol} AS symbol"
    )
    labelled = L.label_news(news, bars)
    rows = labelled.groupBy("news_id").agg(F.first("label").alias("label"))
    assert rows.where("label = 'good'").count() == 300_000
    labelled.collect()
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_joins_without_broadcast_equal_loops(spark, market, no_broadcast):
    test_label_equals_loop(spark, market, 3)
    test_calendar_label_equals_loop(spark, market, 15)
    test_joins_equal_loops(spark, market)
