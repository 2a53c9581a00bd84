"""The bounds by which pairs are ruled out are never below the true overlap."""

import random

import numpy as np
from pyspark.sql import functions as F

from bellwire.llm import line_dedup, ngram_join, token_order


def overlapping(words: int, texts: int) -> list[list[str]]:
    rng = random.Random(words)
    base = [f"w{rng.randrange(10 * words)}" for _ in range(words)]
    return [[w if rng.random() > i / (4 * texts) else f"x{i}{w}" for w in base] for i in range(texts)]


def test_line_signature_bounds_common_words(spark):
    for size in (6, 40, 900):
        texts = [" ".join(words) for words in overlapping(size, 6)]
        grams = [set(t.split()) for t in texts]
        docs = spark.createDataFrame([(0, "\n".join(texts))], "doc_id LONG, text STRING")
        order = token_order.token_order(docs, lambda part: line_dedup.line_tokens(part["text"])[0])
        lines = line_dedup.prefix_rows(docs, order).select(F.shiftright("line", 32).alias("line"), "n", F.array(*line_dedup.SIGN))
        both = lines.toDF("a", "na", "sa").crossJoin(lines.toDF("b", "nb", "sb"))
        most = token_order.most_common("na", "nb", "sa", "sb", line_dedup.SIGN_WORDS)
        for r in both.select("a", "b", most.alias("most")).collect():
            assert r["most"] >= len(grams[r["a"]] & grams[r["b"]])
            if r["a"] == r["b"]:
                assert r["most"] == len(grams[r["a"]])


def test_first_common_token_of_a_match_always_counts(spark):
    """Random sets on both sides of the threshold, in a common order, with clashing upper bits of hashes."""
    rng = np.random.default_rng(7)
    rows, matches = [], []
    for k in range(400):
        low = int(rng.integers(1, 60))
        # Tokens that differ in their lowest bits only have one rank in the quick sort.
        pool = np.unique(rng.integers(0, 40, 3 * low).astype(np.uint64) + (rng.integers(0, 3, 3 * low).astype(np.uint64) << np.uint64(40)))
        drop = rng.random(2) * 0.3
        sides = [rng.permutation(pool[rng.random(len(pool)) >= d]) for d in drop]
        if not all(len(s) for s in sides):
            continue
        flat = np.concatenate(sides)
        tokens, owners = token_order.ordered_sets(flat, np.repeat([0, 1], [len(s) for s in sides]), None)
        x, y = tokens[owners == 0].tolist(), tokens[owners == 1].tolist()
        assert set(x) == set(sides[0].tolist()) and len(x) == len(set(x))
        both = set(x) & set(y)
        assert [t for t in x if t in both] == [t for t in y if t in both]
        if both:
            first = next(t for t in x if t in both)
            rows.append((k, len(x), len(y), x.index(first), y.index(first)))
            if 100 * len(both) >= 80 * len(set(x) | set(y)):
                matches.append(k)
    assert len(matches) > 30
    made = spark.createDataFrame(rows, "k INT, n LONG, m LONG, i LONG, j LONG")
    passed = {r["k"] for r in made.where(token_order.first_common("n", "m", "i", "j", 80)).collect()}
    assert set(matches) <= passed and len(passed) < len(rows)


def test_set_signature_bounds_overlap(spark):
    for size in (5, 300, 5000):
        texts = [" ".join(words) for words in overlapping(size, 6)]
        grams = [{tuple(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)} for t in texts]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
        order = token_order.token_order(docs, lambda part: ngram_join.shingles(part["text"], 4)[0])
        sets = ngram_join.document_sets(docs, order, 4).select("doc_id", "n", "sign")
        x = sets.toDF("a", "na", "sa")
        y = sets.toDF("b", "nb", "sb")
        for r in x.crossJoin(y).select("a", "b", token_order.most_common("na", "nb", "sa", "sb", ngram_join.SIGN_WORDS).alias("most")).collect():
            assert r["most"] >= len(grams[r["a"]] & grams[r["b"]])
            if r["a"] == r["b"]:
                assert r["most"] == len(grams[r["a"]])
