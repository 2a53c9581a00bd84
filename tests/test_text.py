import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from bellwire.functions import han
from bellwire.functions import text as T
from bellwire.operators import linking as K
from bellwire.operators import vectors as V
from bellwire.sources import files


def doc_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")


def random_texts(n=60):
    rng = random.Random(3)
    words = ["alpha", "beta", "Gamma", "über", "d4", "x", "the", "of", "naïve"]
    return [
        "".join(rng.choice(words) + rng.choice([" ", ", ", "--", "\n"]) for _ in range(rng.randrange(0, 80)))
        for _ in range(n)
    ] + ["", " .,; ", "the the the"]


def plain_words(text):
    return [w for w in re.split(r"[^\w]+|_", text.lower()) if w]


def test_counts_equal_counter(spark):
    texts = random_texts()
    docs = doc_frame(spark, texts).select("doc_id", T.tokens(F.col("text")).alias("w"))
    got = {(r["doc_id"], r["token"]): r["tf"] for r in T.token_counts(docs, "w", "doc_id").collect()}
    assert got == {(i, w): c for i, t in enumerate(texts) for w, c in Counter(plain_words(t)).items()}


def test_counting_does_not_shuffle(spark):
    docs = doc_frame(spark, random_texts())
    plan = V.bag_of_words(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_tfidf_equals_formula(spark):
    texts = random_texts()
    stop = spark.createDataFrame([("the",), ("of",)], "word STRING")
    docs = doc_frame(spark, texts)
    bow = V.bag_of_words(docs, stop)
    got = V.tfidf_weights(bow, V.inverse_frequencies(bow, docs)).collect()
    counts = [Counter(w for w in plain_words(t) if w not in ("the", "of")) for t in texts]
    df = Counter(w for c in counts for w in c)
    want = {}
    for i, c in enumerate(counts):
        raw = {w: n * math.log2(len(texts) / df[w]) for w, n in c.items() if df[w] < len(texts)}
        size = math.sqrt(sum(x * x for x in raw.values()))
        want.update({(i, w): x / size for w, x in raw.items()})
    assert {(r["doc_id"], r["token"]) for r in got} == set(want)
    for r in got:
        assert abs(r["weight"] - want[r["doc_id"], r["token"]]) < 1e-12


def test_dictionary_ids(spark):
    bow = V.bag_of_words(doc_frame(spark, ["b a b", "c a", "d"]))
    got = [tuple(r) for r in V.dictionary(bow).orderBy("token_id").collect()]
    assert got == [("a", 0, 2, 2), ("b", 1, 1, 2), ("c", 2, 1, 1), ("d", 3, 1, 1)]


def test_dense_rows(spark):
    weights = spark.createDataFrame(
        [(1, 0, 0.5), (1, 3, 0.5), (2, 1, 1.0)], "d INT, i INT, w DOUBLE"
    )
    got = {r["d"]: r["dense"] for r in V.dense_rows(weights, "d", "i", "w", 4).collect()}
    assert got == {1: [0.5, 0, 0, 0.5], 2: [0, 1.0, 0, 0]}


def test_mentions(spark):
    listings = spark.createDataFrame(
        [("acme", "sh1", 1), ("acme", "sh2", 2), ("bolt", "sh3", 1), ("ox", "sh4", 1), ("the", "sh5", 1)],
        "name STRING, symbol STRING, load_order INT",
    )
    news = spark.createDataFrame(
        [
            (1, "Acme up", "acme and Bolt, acme"),
            (2, None, "bolt"),
            (3, "The ox", "nothing"),
            (4, "acmebolt", "none"),
        ],
        "doc_id BIGINT, news_title STRING, news_article STRING",
    )
    stop = spark.createDataFrame([("the",)], "word STRING")
    linked = K.relevant_symbols(K.mention_hits(news, K.symbol_lookup(listings), stop, ["doc_id"]))
    got = {r["doc_id"]: r["relevant_symbols"] for r in linked.collect()}
    assert got == {1: ["sh2", "sh3"], 2: ["sh3"]}
    assert [r["doc_id"] for r in K.news_for_symbol(linked, "sh2").collect()] == [1]
    assert {r["doc_id"] for r in K.news_for_code_text(linked, "sh").collect()} == {1, 2}
    written = {
        r["doc_id"]: r["relevant_symbols"] for r in K.link_writeback(news, linked).collect()
    }
    assert written == {1: ["sh2", "sh3"], 2: ["sh3"], 3: None, 4: None}


def test_mentions_without_broadcast(spark):
    """The same result when no side may be broadcast, with one name in most articles."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    names = spark.createDataFrame([("acme", "sh1"), ("bolt", "sh2")], "name STRING, symbol STRING")
    stop = spark.createDataFrame([("the",)], "word STRING")
    rows = [(i, f"acme {'bolt' if i % 7 == 0 else ''} the {i}") for i in range(500)]
    news = spark.createDataFrame(rows, "doc_id BIGINT, news_article STRING")
    with_hint = K.mention_hits(news, names, stop, ["doc_id"], title=None).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        words = K.article_words(news, ["doc_id"], None, "news_article")
        without = K.token_symbols(words, names).select("doc_id", "symbol").distinct()
        assert sorted(map(tuple, with_hint.collect())) == sorted(map(tuple, without.collect()))
        assert with_hint.count() == 500 + 72
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_han_segments(spark):
    text = doc_frame(spark, ["贵州茅台上涨3.5%，A股bank大涨", "", None])
    words = han.segment(spark, F.col("text"), ["贵州", "贵州茅台", "上涨", "大涨"])
    got = [r["w"] for r in text.orderBy("doc_id").select(words.alias("w")).collect()]
    assert got == [["贵州茅台", "上涨", "3", "5", "A", "股", "bank", "大涨"], [], []]


def test_han_mentions(spark):
    """Names are dictionary words, so every article that has one is found."""
    names = spark.createDataFrame(
        [("贵州茅台", "sh600519"), ("平安银行", "sz000001"), ("万科", "sz000002")],
        "name STRING, symbol STRING",
    )
    stop = spark.createDataFrame([("的",)], "word STRING")
    news = spark.createDataFrame(
        [
            (1, "贵州茅台的股价", "平安银行与贵州茅台上涨"),
            (2, None, "万科下跌"),  # two characters are too short for a name
            (3, "平安", "银行"),
        ],
        "doc_id BIGINT, news_title STRING, news_article STRING",
    )
    known = [r["name"] for r in names.collect()]
    hits = K.mention_hits(
        news, names, stop, ["doc_id"], tokenizer=lambda c: han.segment(spark, c, known)
    )
    got = {r["doc_id"]: r["relevant_symbols"] for r in K.relevant_symbols(hits).collect()}
    assert got == {1: ["sh600519", "sz000001"]}


def test_word_lists(spark, tmp_path):
    (tmp_path / "gbk.txt").write_bytes("的\r\n 了 \r\n\r\n、\r\n".encode("gbk"))
    (tmp_path / "utf8.txt").write_text("股票\n　基金\n \n", encoding="utf-8")
    gbk = files.word_list(spark, str(tmp_path / "gbk.txt"), "GBK")
    utf = files.word_list(spark, str(tmp_path / "utf8.txt"))
    assert [r["word"] for r in gbk.collect()] == ["的", "了", "、"]
    assert sorted(files.bounded_words(utf)) == ["基金", "股票"]


def test_common_words_of_a_large_vocabulary_are_broadcast(spark, monkeypatch):
    import bellwire.session as session

    docs = doc_frame(spark, random_texts())
    bow = V.bag_of_words(docs).cache()
    idf = V.inverse_frequencies(bow, docs)
    want = {(r["doc_id"], r["token"]): r["weight"] for r in V.tfidf_weights(bow, idf).collect()}
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", idf.count() - 1)
    monkeypatch.setattr(V, "COMMON_WORDS", 3, raising=False)
    split = V.tfidf_weights(bow, session.settled(idf))
    assert "Union" in split._jdf.queryExecution().executedPlan().toString()
    got = {(r["doc_id"], r["token"]): r["weight"] for r in split.collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)
