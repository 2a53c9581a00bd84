"""Undated news, odd markup, line breaks in CSV, and reads without default cuts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bellwire.functions import html as H
from bellwire.operators import asof as A
from bellwire.operators import bars as B
from bellwire.operators import scans as C
from bellwire.operators import vectors as V
from bellwire.sources import files


@pytest.fixture(scope="module")
def bars(spark):
    rows = [("a", dt.date(2024, 1, d), float(d)) for d in (2, 3, 4, 5, 8)]
    return spark.createDataFrame(rows, "symbol string, date date, close double")


@pytest.fixture(scope="module")
def news(spark):
    times = {1: None, 2: "2023-12-01 09:00", 3: "2024-01-04 10:00", 4: "2024-03-01 00:00"}
    df = spark.createDataFrame(list(times.items()), "news_id int, t string").withColumn("symbol", F.lit("a"))
    return df.select("news_id", "symbol", F.to_timestamp_ntz("t").alias("news_time"))


def test_undated_news_has_no_bars(bars, news):
    last = {r["news_id"]: (r["bar_close"], r["history"]) for r in A.asof_last_bar(news, bars).collect()}
    assert last == {1: (None, 0), 2: (None, 0), 3: (4.0, 3), 4: (8.0, 5)}
    ahead = {r["news_id"]: (r["bars_ahead"], r["first_close"]) for r in A.forward_k_bars(news, bars, 2).collect()}
    assert ahead == {1: (0, None), 2: (3, 2.0), 3: (2, 5.0), 4: (0, None)}


def test_links_in_odd_markup(spark):
    page = """<A data-href="/wrong" HREF='/right?a=1&amp;b=2' class='x news_item'>1</a><a href="/two" data-class="news_item">"""
    df = spark.createDataFrame([(page,)], "html string")
    got = df.select(H.link_targets(F.col("html"), None).alias("all"), H.link_targets(F.col("html")).alias("some")).first()
    assert got["all"] == ["/right?a=1&b=2", "/two"] and got["some"] == ["/right?a=1&b=2"]
    upper = spark.createDataFrame([("<ARTICLE class='a'>x &amp; y</Article >",)], "html string")
    assert upper.select(H.flat_text(F.col("html"), "article").alias("t")).first()["t"] == "x & y"


def test_news_csv_with_line_breaks(spark, tmp_path):
    (tmp_path / "n.csv").write_text('news_time,news_article\n2024-01-02 10:00:00,"one\ntwo ""quoted"""\n')
    rows = files.read_news_csv(spark, str(tmp_path / "n.csv")).collect()
    assert [r["news_article"] for r in rows] == ['one\ntwo "quoted"']


def test_reads_are_not_cut(spark):
    many = spark.range(1500).withColumn("n", F.lit(1))
    assert C.paged_scan(many, ["id", "n"], "id").count() == 1500
    page = C.paged_scan(many, ["id"], "id", limit=2, after=F.lit(1400)).collect()
    assert [r["id"] for r in page] == [1401, 1402]
    old = spark.createDataFrame([("a", dt.date(1995, 1, 3))], "symbol string, date date")
    none = old.where("false")
    assert B.incremental_bars(old, none, F.lit("2024-01-29").cast("date")).count() == 1


def test_dense_rows_add_up_and_refuse(spark):
    df = spark.createDataFrame([("d", 1, 2.0), ("d", 1, 3.0)], "k string, i int, v double")
    assert V.dense_rows(df, "k", "i", "v", 3).first()["dense"] == [0.0, 5.0, 0.0]
    with pytest.raises(Exception, match="index outside"):
        V.dense_rows(df, "k", "i", "v", 1).collect()
