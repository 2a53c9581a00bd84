from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from bellwire.functions import scalars as S


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("day", "expected"),
    [
        ("2024-11-18", "2024-11-15"),  # Monday
        ("2024-11-19", "2024-11-18"),
        ("2024-11-20", "2024-11-19"),
        ("2024-11-21", "2024-11-20"),
        ("2024-11-22", "2024-11-21"),
        ("2024-11-23", "2024-11-22"),  # Saturday
        ("2024-11-24", "2024-11-22"),  # Sunday
    ],
)
def test_recent_weekday(spark, day, expected):
    got = one(spark, S.recent_weekday(F.col("d").cast("date")), d=day)
    assert got == date.fromisoformat(expected)


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("https://a.example.com/2024/11/18153042.shtml", "2024-11-18 15:30"),
        ("https://a.example.com/x/2024/11/181530/2023/01/010203", "2024-11-18 15:30"),
        ("https://a.example.com/news/42.html", ""),
        ("https://a.example.com/2024/1/181530", ""),
    ],
)
def test_url_time(spark, url, expected):
    assert one(spark, S.url_time(F.col("u")), u=url) == expected


@pytest.mark.parametrize(
    ("moment", "expected"),
    [
        ("2024-11-18 00:00:00", "2024-11-18"),
        ("2024-11-18 00:00:00.000001", "2024-11-19"),
        ("2024-11-18 15:30:00", "2024-11-19"),
        ("2024-12-31 23:59:59.999999", "2025-01-01"),
    ],
)
def test_first_midnight(spark, moment, expected):
    got = one(spark, S.first_midnight(F.col("t").cast("timestamp_ntz")), t=moment)
    assert got == date.fromisoformat(expected)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-11-18", datetime(2024, 11, 18)),
        ("2024-11-18 09:30:00+08:00", datetime(2024, 11, 18, 9, 30)),
        ("2024-11-18T09:30:00Z", datetime(2024, 11, 18, 9, 30)),
        ("2024-11-18 09:30:00 -0500", datetime(2024, 11, 18, 9, 30)),
        ("no date", None),
    ],
)
def test_naive_timestamp(spark, text, expected):
    assert one(spark, S.naive_timestamp(F.col("t")), t=text) == expected


def test_han_and_blank(spark):
    assert one(spark, S.contains_han(F.col("t")), t="abc股def")
    assert not one(spark, S.contains_han(F.col("t")), t="abc, ß")
    assert one(spark, S.strip_blank(F.col("t")), t="\t 股票 x　\r\n") == "股票 x"
    assert one(spark, S.strip_newlines(F.col("t")), t="a\r\nb\nc") == "abc"


def test_ratios(spark):
    assert one(spark, S.price_change(F.col("o"), F.col("c")), o=0.0, c=1.0) is None
    assert one(spark, S.price_change(F.col("o"), F.col("c")), o=2.0, c=3.0) == 0.5
    assert one(spark, S.log_ratio(F.col("o"), F.col("c")), o=0.0, c=1.0) is None


def test_title_is_optional(spark):
    joined = S.title_and_article(F.col("t").cast("string"), F.col("a"))
    assert one(spark, joined, t=None, a="text") == "text"
    assert one(spark, joined, t="head", a="text") == "head text"


def test_threshold_is_neutral(spark):
    label = S.three_way_label(F.col("r"), F.col("m"), F.col("s"))
    assert one(spark, label, r=0.75, m=0.5, s=0.25) == "neutral"
    assert one(spark, label, r=0.25, m=0.5, s=0.25) == "neutral"
    assert one(spark, label, r=0.76, m=0.5, s=0.25) == "good"
    assert one(spark, label, r=0.24, m=0.5, s=0.25) == "bad"
