import json

import pytest
from pyspark.sql import functions as F

from bellwire.functions import messages as M
from bellwire.sources import messages as Q
from bellwire.streaming import jobs as J

GOOD = {"news_time": "2024-11-18 09:30", "news_title": "t", "news_article": "a\r\nb"}
CASES = [
    (json.dumps(GOOD), None),
    (json.dumps({**GOOD, "news_title": None}), None),
    (json.dumps({**GOOD, "extra": [1]}), None),
    (json.dumps({**GOOD, "news_article": 5}), "bad_type"),
    (json.dumps({**GOOD, "news_article": None}), "bad_type"),
    (json.dumps({"news_time": "x", "news_article": "y"}), "missing_key"),
    ("{}", "missing_key"),
    ("[1,2]", "not_object"),
    ('"text"', "not_object"),
    ("null", "not_object"),
    ("not json", "bad_json"),
    ("", "bad_json"),
    (None, "bad_json"),
]


@pytest.mark.parametrize(("value", "reason"), CASES)
def test_reasons(spark, value, reason):
    frame = spark.createDataFrame([(value,)], "value STRING")
    dead = [r["reason"] for r in M.dead_letters(frame).collect()]
    assert dead == ([reason] if reason else [])
    assert M.clean_news(frame).count() == (0 if reason else 1)


def test_clean_and_payload(spark):
    frame = spark.createDataFrame([(json.dumps(GOOD),)], "value STRING")
    got = M.clean_news(frame).first().asDict()
    assert got == {**GOOD, "news_article": "ab"}
    news = spark.createDataFrame([("t", None)], "news_time STRING, news_title STRING")
    assert json.loads(M.payload(news).first()["value"]) == {"news_time": "t", "news_title": None}


def add_file(spark, folder, values, first):
    """A parquet file with the columns of a topic."""
    data = [(v.encode() if v is not None else None, 0, first + i) for i, v in enumerate(values)]
    frame = spark.createDataFrame(data, "value BINARY, partition INT, offset BIGINT")
    frame.coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    stream = Q.message_stream(
        spark, "parquet", "value BINARY, partition INT, offset BIGINT", folder,
        maxFilesPerTrigger="1",
    )
    return Q.decoded(stream)


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_ingest_restarts_without_duplicates(spark, tmp_path):
    folder, out, check = (str(tmp_path / p) for p in ("in", "out", "check"))
    values = [v for v, _ in CASES]
    add_file(spark, folder, values, 0)
    add_file(spark, folder, values[:3], 100)
    run(J.start_ingest(source(spark, folder), out, check, J.drain_trigger()))
    add_file(spark, folder, values[3:5], 200)
    run(J.start_ingest(source(spark, folder), out, check, J.drain_trigger()))
    run(J.start_ingest(source(spark, folder), out, check, J.drain_trigger()))

    everything = spark.read.parquet(folder).select(F.col("value").cast("string").alias("value"))
    news = spark.read.parquet(f"{out}/news").select(*M.KEYS)
    assert sorted(map(str, news.collect())) == sorted(
        map(str, M.clean_news(everything).select(*M.KEYS).collect())
    )
    dead = spark.read.parquet(f"{out}/dead_letters")
    assert dead.count() == M.dead_letters(everything).count() == 12
    audit = {
        r["batch_id"]: (r["min_offset"], r["max_offset"], r["n"])
        for r in spark.read.parquet(f"{out}/offsets").collect()
    }
    assert audit == {0: (0, 12, 13), 1: (100, 102, 3), 2: (200, 201, 2)}


def test_replayed_batch_replaces_itself(spark, tmp_path):
    frame = spark.createDataFrame([(json.dumps(GOOD),)], "value STRING")
    sink = J.ingest_batch(str(tmp_path))
    sink(frame, 5)
    sink(frame, 5)
    assert spark.read.parquet(f"{tmp_path}/news").count() == 1


def test_high_water_across_batches(spark, tmp_path):
    """Only items newer than the mark at batch start, in any order, across restarts."""
    folder, out, check = (str(tmp_path / p) for p in ("in", "out", "check"))
    schema = "feed STRING, news_time STRING"

    def add(*items):
        spark.createDataFrame(items, schema).coalesce(1).write.mode("append").parquet(folder)

    def poll():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        run(J.start_high_water(stream, out, check, trigger=J.drain_trigger()))

    add(("a", "03"), ("a", "01"), ("b", "05"))
    poll()
    add(("a", "02"), ("a", "04"), ("b", ""), ("c", "01"))
    poll()
    add(("a", "04"), ("b", "06"), ("c", "00"))
    poll()
    got = spark.read.parquet(f"{out}/items").groupBy("batch_id", "feed", "news_time").count()
    assert sorted((r["batch_id"], r["feed"], r["news_time"]) for r in got.collect()) == [
        (0, "a", "01"), (0, "a", "03"), (0, "b", "05"),
        (1, "a", "04"), (1, "b", ""), (1, "c", "01"),
        (2, "b", "06"),
    ]
    marks = spark.read.parquet(f"{out}/marks/batch_id=2")
    assert {r["feed"]: r["latest"] for r in marks.collect()} == {"a": "04", "b": "06", "c": "01"}


def test_daily_once(spark, tmp_path):
    folder, out, check = (str(tmp_path / p) for p in ("in", "out", "check"))
    schema = "symbol STRING, ts TIMESTAMP, close DOUBLE"

    def add(*items):
        spark.sql(
            "SELECT symbol, CAST(ts AS TIMESTAMP) AS ts, close FROM VALUES "
            + ", ".join(f"('{s}', '{t}', {c}D)" for s, t, c in items)
            + " AS t(symbol, ts, close)"
        ).coalesce(1).write.mode("append").parquet(folder)

    def poll():
        stream = spark.readStream.schema(schema).parquet(folder)
        run(J.start_append(J.daily_once(stream), out, check, J.drain_trigger()))

    add(("a", "2024-11-18 15:30:00", 1.0), ("b", "2024-11-18 15:31:00", 2.0))
    poll()
    add(("a", "2024-11-18 16:30:00", 9.0), ("a", "2024-11-19 15:30:00", 3.0))
    poll()
    got = sorted((r["symbol"], r["close"]) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1.0), ("a", 3.0), ("b", 2.0)]


def test_options():
    assert Q.topic_options("h:1", "news", max_offsets=10) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "news",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "10",
    }
    assert J.poll_trigger() == {"processingTime": "3600 seconds"}
    assert J.drain_trigger() == {"availableNow": True}
