"""Line dedup on sets of words: lines with changed inner words, and lines of a few words."""

from __future__ import annotations

import brute
import numpy as np

from bellwire.llm import line_dedup


def duplicate_lines(docs):
    """(doc_id, line) of lines whose distinct words have a Jaccard similarity of 0.8 with an earlier line's."""
    rows = [
        (i, n, frozenset(brute.SPACED.findall(line.translate(brute.LOWER))))
        for i, text in sorted(docs)
        for n, line in enumerate((text or "").split("\n"))
    ]
    rows = [r for r in rows if r[2]]
    return {
        (i, n)
        for k, (i, n, x) in enumerate(rows)
        if any(100 * len(x & y) >= 80 * len(x | y) for _, _, y in rows[:k])
    }


def found(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    return {(r["doc_id"], r["line"]) for r in line_dedup.duplicate_lines(line_dedup.narrowed(df)).collect()}


def test_changed_inner_words(spark):
    random = np.random.default_rng(4)
    base = [f"w{x}" for x in random.integers(0, 400, 30)]
    docs = []
    for i in range(150):
        lines = []
        for _ in range(4):
            line = list(base) if random.random() < 0.4 else [f"w{x}" for x in random.integers(0, 400, int(random.integers(3, 25)))]
            for at in random.integers(0, len(line), int(random.integers(0, 5))):
                line[at] = f"w{random.integers(0, 400)}"
            lines.append(" ".join(line))
        docs.append((i, "\n".join(lines)))
    got = found(spark, docs)
    assert got == duplicate_lines(docs) and len(got) > 100
    line = [f"v{x}" for x in range(20)]
    assert found(spark, [(1, " ".join(line)), (2, " ".join([*line[:10], "other", *line[11:]]))]) == {(2, 0)}


def test_lines_of_a_few_words(spark):
    docs = [(1, "Share\nPage 1 of 2\n\n \t"), (2, "share\n\npage 1 OF 2\nShare this"), (3, "a b c d\na b c d e\nx")]
    assert found(spark, docs) == duplicate_lines(docs) == {(2, 0), (2, 2), (3, 1)}
