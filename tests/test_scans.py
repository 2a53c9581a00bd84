import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from bellwire.operators import bars as B
from bellwire.operators import scans as C
from bellwire.session import small_side
from bellwire.sources import files, sinks


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame(
        [(1, "a", 10), (2, "b", None), (3, "a", 30), (4, "c", 40)], "id INT, kind STRING, n INT"
    )


def test_strict_and_lenient_projection(spark, base):
    with pytest.raises(AnalysisException):
        C.collection_scan(base, "id", keys=["id", "absent"]).collect()
    got = C.collection_scan(base, "id", F.col("id") > 1, ["id", "kind"], max_rows=2)
    assert rows(got) == [(2, "b"), (3, "a")]
    # The page is cut first, then rows with a null go: (2) is in the page but not in the result.
    assert rows(C.paged_scan(base, ["id", "n"], "id", skip=1, limit=2)) == [(3, 30)]
    assert rows(C.paged_scan(base, ["id", "absent"], "id")) == []


def test_keyed_update(spark, base):
    patch = spark.createDataFrame([(1, None, "x"), (4, 44, "y")], "id INT, n INT, tag STRING")
    assert rows(C.keyed_update(base, patch, "id")) == [
        (1, "a", None, "x"), (2, "b", None, None), (3, "a", 30, None), (4, "c", 44, "y"),
    ]
    got = C.update_first(base, F.col("kind") == "a", {"n": F.lit(99)}, "id")
    assert rows(got) == [(1, "a", 99), (2, "b", None), (3, "a", 30), (4, "c", 40)]


def test_distinct_and_union(spark, base):
    assert rows(C.distinct_values(base, ["kind", "n"])) == [
        ("kind", "a"), ("kind", "b"), ("kind", "c"), ("n", "10"), ("n", "30"), ("n", "40"),
    ]
    both = C.union_sources({"x": base.select("id"), "y": base.select("id", "kind")})
    assert both.count() == 8 and both.where("kind is null").count() == 4


def test_regex_is_not_escaped(spark, base):
    assert rows(C.regex_search(base, "kind", "^[ab]$"))[0][0] == 1
    assert C.regex_search(base, "kind", "a.").count() == 0


def test_cutoff_is_positional(spark):
    """Items after the first known one are left out even if they are newer."""
    items = spark.createDataFrame(
        [
            ("f", 1, "05"), ("f", 2, ""), ("f", 3, "03"), ("f", 4, "09"),
            ("g", 1, ""), ("g", 2, "04"), ("h", 1, "01"),
        ],
        "feed STRING, pos INT, t STRING",
    )
    got = C.feed_cutoff(items, "feed", "pos", "t", F.lit("03"))
    assert rows(got, "feed", "pos") == [("f", 1, "05"), ("f", 2, ""), ("g", 1, ""), ("g", 2, "04")]
    assert rows(C.feed_high_water(items, "feed", "pos", "t")) == [
        ("f", "05"), ("g", "04"), ("h", "01"),
    ]


def test_cap_with_a_hot_feed(spark):
    rng = random.Random(1)
    data = [("hot" if i % 3 == 0 else f"f{i % 40}", i, rng.randrange(50)) for i in range(9000)]
    items = spark.createDataFrame(data, "feed STRING, id INT, t INT")
    got = C.feed_cap(items, "feed", [F.col("t").desc(), F.col("id")], cap=100)
    want = []
    for feed in {d[0] for d in data}:
        want += sorted((d for d in data if d[0] == feed), key=lambda d: (-d[2], d[1]))[:100]
    assert rows(got) == sorted(want)


def test_global_row_number(spark):
    rng = random.Random(2)
    data = [(rng.randrange(40), f"k{i}") for i in range(5000)]
    frame = spark.createDataFrame(data, "a INT, b STRING").repartition(7)
    got = C.global_row_number(frame, [F.col("a"), F.col("b")], "n")
    assert rows(got, "n") == [(*d, i) for i, d in enumerate(sorted(data), 1)]
    pages = C.page_numbers(frame.select("b"), "b", size=1000).groupBy("page").count()
    assert rows(pages) == [(i, 1000) for i in range(5)]


def test_count_gate(spark):
    frame = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2, "symbol STRING")
    assert rows(C.min_count_gate(frame, "symbol", 3)) == [("a",)] * 5


def test_small_side_is_measured(spark):
    frame = spark.range(100)
    hinted = spark.range(10**6).join(small_side(frame, max_rows=100), "id")
    plain = spark.range(10**6).join(small_side(frame, max_rows=99), "id")
    narrow = spark.range(10**6).join(small_side(frame, max_bytes=10), "id")

    def has_hint(df):
        return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString() or (
            "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()
        )

    assert has_hint(hinted) and not has_hint(plain) and not has_hint(narrow)
    assert hinted.count() == plain.count() == 100


def test_incremental_bars(spark):
    schema = "symbol STRING, date DATE"
    days = spark.sql(
        "SELECT s AS symbol, explode(sequence(date'2024-11-11', date'2024-11-18')) AS date "
        "FROM VALUES ('old'), ('new'), ('done') AS t(s)"
    )
    stored = spark.sql(
        "SELECT * FROM VALUES ('old', date'2024-11-14'), ('done', date'2024-11-15') AS t(symbol, date)"
    )
    assert stored.schema.simpleString() == days.schema.simpleString(), schema
    # Monday: the weekday before is Friday the 15th, so 'done' is skipped as a whole.
    got = B.incremental_bars(days, stored, F.lit("2024-11-18").cast("date"))
    counts = {r["symbol"]: r["count"] for r in got.groupBy("symbol").count().collect()}
    assert counts == {"old": 4, "new": 8}


def test_snapshots(spark):
    ticks = spark.sql(
        "SELECT symbol, CAST(ts AS TIMESTAMP_NTZ) AS ts, value FROM VALUES "
        "('a', '2024-11-18 15:29:59', 1.0D), ('a', '2024-11-18 15:30:00', 2.0D), "
        "('a', '2024-11-18 16:00:00', 3.0D), ('b', '2024-11-18 09:00:00', 4.0D) AS t(symbol, ts, value)"
    )
    assert [r["value"] for r in B.after_close_ticks(ticks).collect()] == [2.0]
    got = B.first_per_day(ticks).select("symbol", "value", "dropped")
    assert rows(got) == [("a", 1.0, 2), ("b", 4.0, 0)]


def test_bar_sinks_and_csv(spark, tmp_path):
    bars = spark.sql(
        "SELECT 'a' AS symbol, date'2024-11-18' AS date, 0.1D AS open, 1D AS high, 0D AS low, "
        "1D/3 AS close, 5D AS volume UNION ALL SELECT 'b', date'2024-11-19', 1D, 1D, 1D, 1D, 1D"
    )
    path = str(tmp_path / "bars")
    sinks.write_by_symbol(bars, path)
    sinks.write_by_symbol(bars, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 4
    plan = stored.where("symbol = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan
    files.write_csv(bars, str(tmp_path / "csv"))
    again = files.read_bars_csv(spark, str(tmp_path / "csv"))
    assert rows(again) == rows(bars)
    (tmp_path / "p.csv").write_text(
        "date,open,high,low,close,volume\n2024-11-18 00:00:00+08:00,1,2,0.5,1.5,9\n"
    )
    got = files.read_prices_csv(spark, str(tmp_path / "p.csv"), "x").first()
    assert str(got["date"]) == "2024-11-18" and got["close"] == 1.5
    (tmp_path / "n.csv").write_text('news_time,news_article\n2024-11-18 09:30:00,"a ""b"", c"\n')
    got = files.read_news_csv(spark, str(tmp_path / "n.csv")).first()
    assert got["news_article"] == 'a "b", c' and got["news_time"].hour == 9


def test_write_if_absent_and_append(spark, tmp_path, base):
    path = str(tmp_path / "dict")
    sinks.write_if_absent(base, path)
    sinks.write_if_absent(base.limit(1), path)
    assert spark.read.parquet(path).count() == 4
    counted, counters = sinks.observed(base, "append", with_n=F.count("n"))
    sinks.append_rows(counted, path)
    assert counters.get == {"rows": 4, "with_n": 3}
    assert spark.read.parquet(path).count() == 8
