"""Chinese words: batches and joins against a plain walk over the characters."""

import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from bellwire.functions import han
from bellwire.operators import han_words as W

CHARS = "股票市场上涨"
RUNS = re.compile("[一-龥]+")


def walk(run, known):
    longest, at = max(map(len, known), default=1), 0
    while at < len(run):
        size = next((n for n in range(min(longest, len(run) - at), 1, -1) if run[at : at + n] in known), 1)
        yield at + 1, run[at : at + size]
        at += size


def made(seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice(CHARS[:3] if rng.random() < 0.7 else CHARS) for _ in range(n))
    known = {word(rng.choice([1, 2, 2, 3, 4, 7])) for _ in range(25)}
    texts = [" ".join(word(rng.randrange(1, 30)) + rng.choice(["", "abc", "，12"]) for _ in range(rng.randrange(6))) for _ in range(120)]
    return sorted(known), texts + [None, "", "no Chinese _ at all", "股" * 5000, "票" * 2 + "股" * 4001]


def test_batches_and_joins(spark):
    known, texts = made(1)
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, "股票")], "doc_id BIGINT, text STRING").repartition(3)
    cut = df.select("doc_id", han.segment(spark, F.col("text"), known).alias("w"))
    got = {r["doc_id"]: r["w"] for r in cut.collect() if r["doc_id"] is not None}
    pieces = [[(h, o) for h, o in han.PIECES.findall(t or "")] for t in texts]
    assert got == {i: [w for h, o in p for w in ([x for _, x in walk(h, known)] if h else [o])] for i, p in enumerate(pieces)}
    dictionary = spark.createDataFrame([(w,) for w in known] * 2, "word STRING")
    rows = {tuple(r) for r in W.han_words(df, dictionary).collect()}
    assert rows == {(i, k, at, w) for i, t in enumerate(texts) for k, run in enumerate(RUNS.findall(t or "")) for at, w in walk(run, known)}


def test_without_words(spark):
    df = spark.createDataFrame([(1, "股票a")], "doc_id BIGINT, text STRING")
    assert df.select(han.segment(spark, F.col("text"), []).alias("w")).first()["w"] == ["股", "票", "a"]
    none = spark.createDataFrame([], "word STRING")
    assert [r["word"] for r in W.han_words(df, none).orderBy("at").collect()] == ["股", "票"]
    assert W.han_words(df.where("false"), none).count() == 0


def test_larger_dictionaries_are_shuffled(spark, monkeypatch):
    import bellwire.session as session

    known, texts = made(3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    dictionary = spark.createDataFrame([(w,) for w in known], "word STRING")
    want = {tuple(r) for r in W.han_words(df, dictionary).collect()}
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", 0)
    assert {tuple(r) for r in W.han_words(df, dictionary).collect()} == want


def test_small_dictionaries_shuffle_no_place(spark):
    known, texts = made(5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    rows = W.han_words(df, spark.createDataFrame([(w,) for w in known], "word STRING"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_runs_over_batches(spark):
    """Runs whose matches come in many batches."""
    known, texts = made(7)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").coalesce(1)
    dictionary = spark.createDataFrame([(w,) for w in known], "word STRING")
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, 3)
    try:
        rows = {tuple(r) for r in W.han_words(df, dictionary).collect()}
    finally:
        spark.conf.set(size, before)
    assert rows == {(i, k, at, w) for i, t in enumerate(texts) for k, run in enumerate(RUNS.findall(t or "")) for at, w in walk(run, known)}


def test_batches_are_cut_by_characters(spark, monkeypatch):
    """A batch of many characters is matched and given back in bounded parts."""
    made_, texts = [], ["股票a" * 9, None, "", "市场" * 70, "上涨"] * 8
    monkeypatch.setattr(han, "CHUNK_CHARS", 50, raising=False)
    monkeypatch.setattr(han.F, "pandas_udf", lambda kind: lambda f: made_.append(f) or (lambda c: c))
    han.segment(spark, None, ["股票", "市场"])
    parts = [p.tolist() for p in made_[0](iter([pd.Series(texts)]))]
    assert len(parts) > 8 and all(len("".join(w for row in p for w in row)) <= 50 or len(p) == 1 for p in parts)
    words = {"股票a" * 9: ["股票", "a"] * 9, None: [], "": [], "市场" * 70: ["市场"] * 70, "上涨": ["上", "涨"]}
    assert [row for p in parts for row in p] == [words[t] for t in texts]


def test_places_are_no_rows(spark, monkeypatch):
    """Words are found in chunks of texts, not by a row for each place; texts and runs lie across chunks as they like."""
    known, texts = made(11)
    texts += ["股票\U00020000股票", "股�票", "\n股票\n市场\n", "一龥" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").coalesce(2)
    monkeypatch.setattr(W, "CHUNK_CHARS", 40)
    rows = W.han_words(df, spark.createDataFrame([(w,) for w in known], "word STRING"))
    assert "Generate" not in rows._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in rows.collect()} == {
        (i, k, at, w) for i, t in enumerate(texts) for k, run in enumerate(RUNS.findall(t or "")) for at, w in walk(run, known)
    }


def test_words_of_one_hash(spark, monkeypatch):
    """Words are compared, whatever their hashes."""
    known, texts = made(13)
    monkeypatch.setattr(W, "mixed", lambda hashes, chars: hashes * np.uint64(0) + (chars & 1).astype(np.uint64))
    tables, names = W.numbered(spark.createDataFrame([(w,) for w in known if len(w) > 1], "word STRING"))
    word = {r["id"]: r["word"] for r in names.collect()}
    text, run, at, ids = (x.tolist() for x in W.words_of([t or "" for t in texts], tables))
    want = [(i, k, a, w) for i, t in enumerate(texts) for k, r in enumerate(RUNS.findall(t or "")) for a, w in walk(r, known)]
    assert list(zip(text, run, at, [word[i] for i in ids])) == want
