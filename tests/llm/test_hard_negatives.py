"""Hard negatives against all scores, and the bounds along the tree of anchors."""

from __future__ import annotations

from collections import Counter

import brute
import numpy as np
from pyspark.sql import functions as F

from bellwire.llm import hard_negatives as H
from bellwire.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, label int, embedding array<double>"


def mined(df):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = H.mine(df.withColumn("label", moved), F.col("vec_id") % 100 == 0)
    assert rows.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in rows.collect())


def plain(df):
    return [(r["vec_id"], r["label"], r["embedding"]) for r in df.collect()]


def test_whole_table(spark):
    df = table(spark, SF, "embeddings")
    want = Counter(brute.hard_negatives(plain(df)))
    assert Counter(tuple(r) for r in QUERIES["op11_hard_negatives"](spark, SF).collect()) == want and want


def test_clusters_ties_and_slices(spark, monkeypatch):
    """Tight clusters, equal vectors and ids out of order; anchors in several slices, candidates in several chunks."""
    monkeypatch.setattr(H, "SLICE_ROWS", 7)
    monkeypatch.setattr(H, "CHUNK", 50)
    random = np.random.default_rng(1)
    centres = random.standard_normal((12, 16)) / 4
    rows = []
    for i in random.permutation(2000).tolist():
        x = centres[i % 12] + (0.02 * random.standard_normal(16) if i % 3 else 0)
        rows.append((i, int(random.integers(0, 10)), x.tolist()))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = Counter(brute.hard_negatives(rows))
    assert mined(df) == want and len(want) > 500


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (100, 1, [1.0, 0.5]), (100, 2, [1.0, 0.5]), (100, 1, [1.0, 0.5]), (200, 3, [-1.0, 0.0]),
        (1, 2, [1.0, 0.5]), (1, 2, [1.0, 0.5]), (2, 1, [0.5, 0.5]), (3, 1, [0.9, 0.4]), (4, 2, [0.4, 0.4]),
        (5, 3, [0.3, 0.2]), (6, 3, [0.3, 0.2]), (8, 3, [-1.0, 1.0]), (7, 9, [0.6, 0.2]),
        (9, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (10, 1, None), (11, 1, [nan, 1.0]), (12, 2, [None, 1.0]),
        (13, 2, [inf, 1.0]), (300, 1, [1.0]), (15, 1, [0.5]), (16, 2, [0.25]), (400, 1, []), (17, 1, []), (18, 2, []),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("dim", "place", "score", "rank", "slice")})
    assert mined(df) == Counter(brute.hard_negatives(rows))
    assert mined(df.where("false")) == Counter()
    assert mined(df.where("vec_id = 0")) == Counter()


def test_large_components(spark):
    """Beyond doubles' whole numbers scores stay exact; beyond longs they are held at the ends."""
    rows = [(0, 0, [5e6, 1.0]), (1, 1, [5e6, 3.0]), (2, 2, [2e6, 7.0]), (3, 2, [2e6, 9.0]), (4, 2, [4e6, -1.0])]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == Counter(brute.hard_negatives(rows)) != Counter()
    huge = [(0, 0, [1e300, 1e300]), (1, 1, [1e300, 1e300]), (2, 2, [1e300, -1e300])]
    assert mined(spark.createDataFrame(huge, SCHEMA)) == Counter()


def test_bounds_spare_scores():
    """In clusters most pairs are ruled out by their bounds; none that enters a window is."""
    random = np.random.default_rng(2)
    centres = 40 * random.standard_normal((8, 12))
    x = np.floor(np.repeat(centres, 20, axis=0) + random.standard_normal((160, 12)))
    order, parents, edges = H.spanning_tree(x)
    assert (parents[1:] < np.arange(1, 160)).all() and np.isclose(edges[1:], np.linalg.norm(x[order][1:] - x[order][parents[1:]], axis=1)).all()
    depth = np.zeros(160, int)
    for i in range(1, 160):
        depth[i] = depth[parents[i]] + 1
    levels = [*np.flatnonzero(np.diff(depth, prepend=-1)).tolist(), 160]
    tree = H.Tree(np.arange(160), np.zeros(160, np.int64), parents, edges, x[order], np.linalg.norm(x[order], axis=1), levels)
    c = np.floor(np.repeat(centres, 30, axis=0) + random.standard_normal((240, 12)))
    score = (x[order] @ c.T).astype(np.int64)
    low = np.sort(score, axis=1)[:, -20:-19]
    best = H.Best(H.Windows(low, np.full((160, 1), H.LONG), True, 10))
    tested = H.search(tree, best, np.arange(1000, 1240), np.zeros(240, np.int64), c)
    assert tested < 0.5 * score.size
    for a in range(160):
        want = sorted((-s, v) for v, s in enumerate(score[a].tolist(), 1000))[:10]
        mine = best.group == a
        assert sorted(zip((-best.score[mine]).tolist(), best.vec[mine].tolist())) == want
