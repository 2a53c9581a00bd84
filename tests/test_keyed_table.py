"""Stored keyed updates: what is written, what stays, and what a reader sees."""

import os

import pytest
from pyspark.sql import functions as F

from bellwire.sources.keyed_table import KeyedTable


def files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    made = KeyedTable(spark, str(tmp_path / "t"), "id", buckets=8)
    rows = spark.range(100).select("id", (F.col("id") * 2).alias("x"), F.lit("old").alias("name"))
    made.create(rows.unionAll(spark.createDataFrame([(None, 1, "keyless"), (None, 2, "keyless")], "id LONG, x LONG, name STRING")))
    return made


def plain(df):
    return {tuple(r) for r in df.collect()}


def test_patches(spark, table):
    before = files(table.path + "/data")
    assert table.read().count() == 102
    touched = table.patch(spark.createDataFrame([(3, None, "new"), (500, "lost", "lost")], "id INT, name STRING, more STRING"))
    assert len(touched) <= 2
    after = files(table.path + "/data")
    # Nothing that was there is gone, and only touched buckets have new files.
    assert before <= after and {f.split("at_bucket=")[1].split("/")[0] for f in after - before} <= {str(b) for b in touched}
    rows = table.read()
    assert rows.columns == ["id", "x", "name", "more"] and rows.count() == 102
    assert rows.where("id = 3").first()[1:] == (6, None, "new")
    assert rows.where("id = 4").first()[1:] == (8, "old", None)
    table.patch(spark.createDataFrame([(3, 7), (4, 8)], "id LONG, x LONG"))
    table.patch(spark.createDataFrame([(None, 9)], "id LONG, x LONG"))
    assert plain(table.read().where("id in (3, 4) or id is null")) == {
        (3, 7, None, "new"), (4, 8, "old", None), (None, 1, "keyless", None), (None, 2, "keyless", None)
    }


def test_insert_and_update_one(spark, table):
    table.patch(spark.createDataFrame([(3, 1), (500, 2)], "id LONG, x LONG"), insert=True)
    assert plain(table.read().where("id in (3, 500)")) == {(3, 1, "old"), (500, 2, None)}
    assert len(table.update_one(F.col("x") > 100, {"name": F.concat("name", F.lit("er"))})) == 1
    assert plain(table.read().where("name = 'older'")) == {(51, 102, "older")}
    assert table.update_one(F.col("x") < 0, {"name": F.lit("none")}) == []


def test_a_failed_patch_is_not_seen(spark, table):
    before = plain(table.read())
    with pytest.raises(Exception, match="key occurs twice"):
        table.patch(spark.createDataFrame([(3, 1), (3, 2)], "id LONG, x LONG"))
    assert plain(table.read()) == before
    # Buckets without a mark, as a writer leaves them that dies before the mark, and its second try.
    table._write = lambda rows, version, touched: KeyedTable._write(table, rows, version, touched.where(F.raise_error(F.lit("dies"))))
    with pytest.raises(Exception):
        table.patch(spark.createDataFrame([(3, 1)], "id LONG, x LONG"))
    assert len(files(table.path + "/data")) > 0 and plain(table.read()) == before
    del table._write
    table.patch(spark.createDataFrame([(3, 1)], "id LONG, x LONG"))
    assert plain(table.read()) == before - {(3, 6, "old")} | {(3, 1, "old")}


def test_tables_are_made_once(spark, table, tmp_path):
    with pytest.raises(ValueError):
        table.create(spark.range(3))
    none = KeyedTable(spark, str(tmp_path / "none"), "id")
    with pytest.raises(ValueError):
        none.read()
    with pytest.raises(ValueError):
        none.patch(spark.range(3).withColumn("x", F.lit(1)))
    none.create(spark.createDataFrame([], "id LONG, x INT"))
    assert none.read().count() == 0 and none.read().columns == ["id", "x"]
    none.patch(spark.createDataFrame([(1, 2)], "id LONG, x INT"), insert=True)
    assert plain(none.read()) == {(1, 2)}
