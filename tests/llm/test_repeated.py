"""Ids that stand for several texts, equal rows, words of one hash, and columns with the operators' own names."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from bellwire.llm import line_dedup, mixing, ngram_join, packing, spans, url_rules

SCHEMA = "doc_id long, text string, source string"
TEXT = "alpha beta gamma delta epsilon zeta eta theta iota kappa"


def test_lines_of_one_id(spark):
    rows = [(0, "baz qux quux", "a"), (1, "foo bar unique words", "a"), (1, "baz qux quux", "a"), (1, "baz qux quux", "b")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup_documents(df).collect())
    assert got == Counter([(0, "baz qux quux"), (1, "foo bar unique words"), (1, ""), (1, "")])
    both = spark.createDataFrame([(1, "one two three\nfour five", "a"), (1, "six seven\none two three", "a")], SCHEMA)
    texts = {r["text"] for r in line_dedup.dedup_documents(both).collect()}
    assert texts == {"one two three\nfour five", "six seven"}


def test_many_equal_rows(spark):
    df = spark.range(4000).select(F.lit(5).cast("long").alias("doc_id"), F.lit(TEXT + "\n" + TEXT).alias("text"), F.lit("a").alias("source"))
    assert {r["text"] for r in line_dedup.dedup_report(df).collect()} == {TEXT}
    assert ngram_join.one_of_each(df).count() == 4000
    assert {(r["component_id"], r["n_shingles"]) for r in ngram_join.join(df).collect()} == {(5, 10)}


def test_one_of_each_keeps_other_texts_of_an_id(spark):
    rows = [(0, TEXT, "a"), (1, "quite other words that nobody else has written down", "a"), (1, TEXT, "a"), (1, TEXT, "b"), (2, TEXT, "c"), (None, TEXT, "d")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("_gone", "_row", "_id", "_hash", "node", "row")})
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([(0, TEXT), (1, rows[1][1]), (None, TEXT)])


def test_mixing_splits_equal_rows(spark):
    words = " ".join(["word"] * 100)
    rows = [(None, words, "a")] * 100 + [(7, words, "b")] * 50 + [(7, words + f" {i}", "b") for i in range(50)] + [(8, words, "c")] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    report = mixing.mix_report(df).collect()
    taken, target = Counter(), {}
    for r in report:
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert len(report) == len(rows) and all(abs(taken[s] - target[s]) <= 101 for s in taken)
    assert any(taken[s] % s for s in taken)
    assert Counter(map(tuple, report)) == Counter(map(tuple, mixing.mix_report(df.repartition(7)).collect()))
    mixed = Counter(r["source"] for r in mixing.mix_documents(df).collect())
    assert {s: n * 100 for s, n in mixed.items() if s != "b"} == {
        s: sum(r["taken"] for r in report if r["doc_id"] == i) for s, i in (("a", None), ("c", 8)) if mixed[s]
    }
    plan = mixing.mix_documents(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_clashing_url_columns(spark):
    df = spark.createDataFrame([(1, "http://b.net/x")], "page_id long, url string")
    clash = df.withColumns({c: F.lit("mine") for c in ("_url", "_best", "_row", "_page", "rule", "token")})
    row = url_rules.judge(clash).first()
    assert row["verdict"] == "block" and row["_url"] == "mine" and row["token"] == "mine"


def words_at(texts):
    data = np.frombuffer(b" ".join(texts), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    return data, ends - [len(t) for t in texts], ends


def thue_morse(n):
    return bytes(97 + bin(i).count("1") % 2 for i in range(n))


def test_hashes():
    rng = random.Random(3)
    texts = [bytes(rng.randrange(256) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += [b"", b"\0", b"\0" * 8, b"\0" * 9, b"\0" * 16, b"a" * 7, b"a" * 8, b"a" * 9, b"ab" * 500, b"ba" * 500]
    first = thue_morse(1024)
    texts += [first, first.translate(bytes.maketrans(b"ab", b"ba")), first[512:] + first[:512]]
    data, starts, ends = words_at(texts)
    hashes = spans.span_hashes(data, starts, ends)
    by_text = {}
    for t, h in zip(texts, hashes.tolist()):
        assert by_text.setdefault(t, h) == h
    assert len(set(by_text.values())) == len(by_text)
    # Wherever a text stands, it has one hash.
    again = [texts[i] for i in rng.sample(range(len(texts)), len(texts))]
    data, starts, ends = words_at(again)
    assert dict(zip(again, spans.span_hashes(data, starts, ends).tolist())) == by_text
    assert spans.same_spans(*words_at([b"abc", b"abc", b"abd"]), np.array([0, 0, 2]))
    assert not spans.same_spans(*words_at([b"abc", b"abc", b"abd"]), np.array([0, 0, 0]))


def test_packing_tells_words_of_one_hash_apart(spark, monkeypatch):
    """Even if all words had one hash, each would get its own ids."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    from bellwire.llm.queries import word_bpe

    monkeypatch.setattr(spans, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    texts = ["several words of one hash", "words told apart", "", thue_morse(300).decode()]
    ids, at = packing.WordIds(word_bpe()).encode(pa.array(texts))
    tokenizer = Tokenizer.from_file(word_bpe())
    want = [tokenizer.encode(t, add_special_tokens=False).ids + [packing.END_ID] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_words_that_come_again_are_kept(monkeypatch):
    """When a task's words grow too many, those that came again stay known and keep their ids."""
    import pyarrow as pa

    from bellwire.llm.queries import word_bpe

    monkeypatch.setattr(packing, "MEMORY", 60)
    words, learnt = packing.WordIds(word_bpe()), []
    word = words.word
    words.word = lambda text: learnt.append(text) or word(text)
    common = " ".join(f"common{chr(97 + i)}" for i in range(10))
    texts = [f"{common} " + " ".join(f"only{i}x{j}" for j in range(20)) for i in range(12)]
    got = [words.encode(pa.array([t]))[0].tolist() for t in texts]
    assert sum(t.startswith("common") for t in learnt) == 10
    assert got == [packing.WordIds(word_bpe()).encode(pa.array([t]))[0].tolist() for t in texts]
