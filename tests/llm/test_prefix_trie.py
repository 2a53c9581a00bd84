"""The prefix trie against sets of prefixes, and the radix tree's layouts."""

from __future__ import annotations

from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from bellwire.llm import prefix_trie as P
from bellwire.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def nodes(df):
    return Counter(tuple(r) for r in df.collect())


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_prefix_trie"](spark, SF)
    assert got.columns[:3] == ["conv_id", "depth", "parent_conv_id"]
    assert nodes(got) == Counter(brute.prefix_trie(rows))


@pytest.mark.parametrize("block", [1, 4 << 20])
def test_shared_prefixes_over_blocks(spark, monkeypatch, block):
    """Few different turns, so that prefixes, copies and long conversations go over block and task borders."""
    monkeypatch.setattr(P, "BLOCK_BYTES", block)
    monkeypatch.setattr(P, "PIECE_IDS", 3)
    random = np.random.default_rng(block)
    rows = []
    for c in range(400):
        n = 60 if c % 50 == 3 else int(random.integers(0, 12))
        for t in range(n):
            x = int(random.integers(0, 3)) if t > 8 and c % 50 != 3 else int(random.integers(0, 2)) if t < 4 else 0
            rows.append((c, t if random.random() > 0.02 else None, "user" if t % 2 else None, f"té{x}" if x else None))
    random.shuffle(rows)
    rows = [(int(c), None if t is None else int(t), r, x) for c, t, r, x in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = Counter(brute.prefix_trie(rows))
    assert nodes(P.prefix_trie(df)) == want and max(r[3] for r in want) > 100


def test_awkward_rows(spark):
    rows = [
        (0, None, None, None), (0, 1, "user", ""), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, 1, "user", "b"),
        (2, 5, "", "user"), (3, 5, "us", "er"), (7, 0, "x", "only"), (12, None, None, None), (None, 0, "user", "lost"),
        (21, 2**40, "u", "x" * 200_000), (22, 3, "u", "x" * 200_000), (26, 0, "u", "1:u"),
    ]
    clash = {c: F.lit(3) for c in ("depth", "key", "id", "n", "path", "family", "said", "digest")}
    df = spark.createDataFrame(rows, SCHEMA).withColumns(clash)
    assert nodes(P.prefix_trie(df)) == Counter(brute.prefix_trie(rows))
    assert P.prefix_trie(df.where("false")).count() == 0
    one = [(11, 0, "user", "hello")]
    assert nodes(P.prefix_trie(spark.createDataFrame(one, SCHEMA))) == Counter(brute.prefix_trie(one))


def test_radix_tree_layouts():
    """Nodes of 4, 16, 48 and 256 children, keys that are prefixes of others, split paths."""
    random = np.random.default_rng(0)
    keys = {bytes(random.integers(0, 256, int(n)).astype(np.uint8)) for n in random.integers(0, 5, 3000)}
    keys |= {b"\x07" * n for n in range(40)} | {b"path" + bytes([i]) * 9 for i in range(60)}
    keys |= {b"forty" + bytes([5 * i]) for i in range(40)}
    tree = P.RadixTree()
    shuffled = list(keys)
    random.shuffle(shuffled)
    for i, key in enumerate(shuffled):
        tree.insert(key, i)
    found, layouts = [], Counter()

    def walk(node, prefix):
        prefix = prefix + node.path
        layouts[node.layout] += 1
        if node.ends is not None:
            found.append((prefix, node.ends))
        kids = [(byte, node.get(byte)) for byte in range(256)]
        kids = [(byte, kid) for byte, kid in kids if kid is not None]
        assert [k for _, k in kids] == node.children()
        assert len(kids) > 1 or node.ends is not None or node is tree.root
        for byte, kid in kids:
            walk(kid, prefix + bytes([byte]))

    walk(tree.root, b"")
    assert [k for k, _ in found] == sorted(keys)
    assert all(shuffled[i] == k for k, i in found)
    assert set(layouts) == {4, 16, 48, 256}
