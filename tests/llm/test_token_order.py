"""Counting tokens in little memory, classes of known tokens, and the pairs that a line may enter."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bellwire.llm import line_dedup, spans, token_order
from bellwire.llm.token_order import LEAST_IN_BLOCK, TokenOrder


def test_counting_holds_little_more_than_the_tokens():
    """Shingles hardly repeat: counting all of them held a task's tokens seven times over."""
    rng = np.random.default_rng(5)
    blocks = [rng.integers(0, 1 << 63, 1 << 14).astype(np.uint64) for _ in range(64)]
    blocks += [np.repeat(blocks[0][:10], k) for k in (3, LEAST_IN_BLOCK - 1)]
    size = sum(b.nbytes for b in blocks)
    tracemalloc.start()
    found, times = token_order.frequent(blocks, LEAST_IN_BLOCK)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 10 and (times == LEAST_IN_BLOCK + 3).all()
    assert peak < 1.6 * size


def test_frequent_tokens_are_those_of_a_full_count():
    rng = np.random.default_rng(6)
    for n in (0, 1, LEAST_IN_BLOCK - 1, LEAST_IN_BLOCK, 40, 500):
        tokens = rng.integers(0, 9, n).astype(np.uint64)
        all_, times = np.unique(tokens, return_counts=True)
        found, counts = token_order.frequent([tokens[: n // 2], tokens[n // 2 :]], LEAST_IN_BLOCK)
        assert found.tolist() == all_[times >= LEAST_IN_BLOCK].tolist()
        assert counts.tolist() == times[times >= LEAST_IN_BLOCK].tolist()


def test_classes_of_known_tokens_whatever_their_upper_bits():
    rng = np.random.default_rng(7)
    ends = np.array([0, 1 << 63, (1 << 64) - 1], np.uint64)
    close, wide = rng.integers(0, 1 << 40, 2000).astype(np.uint64), rng.integers(0, 1 << 63, 2000).astype(np.uint64) * np.uint64(2)
    known = np.unique(np.concatenate((close, wide, ends)))
    classes = np.arange(1, len(known) + 1).astype(np.uint16)
    asked = np.concatenate((known, known + np.uint64(1), rng.integers(0, 1 << 40, 500).astype(np.uint64)))
    want = dict(zip(known.tolist(), classes.tolist()))
    assert TokenOrder(known, classes).of(asked).tolist() == [want.get(x, 0) for x in asked.tolist()]
    assert TokenOrder(known[:0], classes[:0]).of(asked).tolist() == [0] * len(asked)


def test_runs_end_with_their_text():
    texts = ["", "ab", "cd ", "", "é", " x\ty", None, "Z", "\n"]
    data, at = spans.text_bytes(pa.array(texts))
    starts, ends, rows = spans.runs(data, at, spans.SPACED)
    words = [(r, data[a:b].tobytes().decode()) for a, b, r in zip(starts, ends, rows)]
    assert words == [(i, w) for i, t in enumerate(texts) for w in (t or "").split()]
    every = np.arange(256, dtype=np.uint8)
    assert (spans.lowered(every) == spans.LOWER).all() and (spans.spaced(every) == spans.SPACED).all()


def test_largest_partner_is_where_the_overlap_needed_ends(spark):
    rows = spark.range(1, 61).select(F.col("id").alias("n")).crossJoin(spark.range(0, 13).select(F.col("id").alias("i")))
    found = rows.where("i < n AND 5 * i <= n").select("n", "i", line_dedup.largest_partner(F.col("n"), F.col("i")).alias("most")).collect()
    for n, i, most in found:
        # All of a line's words from place i on in common with one that holds no others.
        fits = [m for m in range(1, 200) if n - i >= -(-line_dedup.PERCENT * (n + m) // (100 + line_dedup.PERCENT))]
        assert most == max(fits)


def test_pairs_of_a_token_fall_before_signatures_and_both_sides_read_one_exchange(spark):
    cols = "token long, doc_id long, line long, at long, s0 long, s1 long"
    place = lambda n, i: n << 32 | i
    rows = [(1, 1, 0, place(10, 0), 0, 0), (1, 2, 0, place(10, 0), 0, 0), (1, 3, 0, place(13, 0), 0, 0), (1, 4, 0, -1 - place(10, 2), 0, 0), (1, 5, 0, place(10, 2), 0, 0)]
    full = spark.createDataFrame(rows, cols).repartition("token")
    x, y = line_dedup.meeting(full, "x"), line_dedup.meeting(full, "y")
    open_ = (F.col("token_x") == F.col("token_y")) & (F.col("n_y") <= F.col("most_x")) & (F.col("n_x") <= F.col("most_y"))
    pairs = x.hint("merge").join(y, open_ & line_dedup.earlier()).select("doc_id_x", "doc_id_y")
    # 13 words are too many for 10; at place 2 of 10 only lines of 8 words fit; a negated place is no later line.
    assert sorted(map(tuple, pairs.collect())) == [(1, 2)]
    assert "ReusedExchange" in pairs._jdf.queryExecution().executedPlan().toString()
