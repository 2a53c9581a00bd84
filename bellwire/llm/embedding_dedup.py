"""Near-equal embeddings by counting collisions of one-dimensional projections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bellwire.llm.graph import components
from bellwire.session import stored

THRESHOLD = 0.98
PROJECTIONS = 32
# Half width of a window, in deviations of the projected distance of vectors just at the threshold.
WIDTH = 2.5
RECALL = 0.9999
SEED = 8
# Vectors of a block; two blocks meet in a task.
BLOCK = 2048


def directions(dim: int, n: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """Seeded orthonormal directions, as columns; sets of ``dim`` of them are independent."""
    random = np.random.default_rng([seed, dim])
    sets = [np.linalg.qr(random.standard_normal((dim, dim)))[0] for _ in range(-(-n // dim))]
    return np.concatenate(sets, axis=1)[:, :n]


def window(dim: int, threshold: float) -> float:
    """Half width of the windows; no wider than the distance of two vectors at the threshold."""
    distance = math.sqrt(2 - 2 * threshold)
    return min(distance, WIDTH * distance / math.sqrt(dim)) + 1e-12


def least_collisions(dim: int, threshold: float, n: int = PROJECTIONS, recall: float = RECALL) -> int:
    """The largest count that a pair at the threshold reaches with probability ``recall``.

    A direction's share of a distance is that of a random unit vector's coordinate; its
    collision rate is simulated with a fixed seed, the count follows a binomial.
    """
    random = np.random.default_rng([SEED, dim, 1])
    x = random.standard_normal((20_000, dim))
    share = np.abs(x[:, 0]) / np.linalg.norm(x, axis=1)
    rate = float(np.mean(share * math.sqrt(2 - 2 * threshold) <= window(dim, threshold)))
    if rate >= 1.0:
        return n
    tail = 0.0
    for count in range(n, -1, -1):
        tail += math.comb(n, count) * rate**count * (1 - rate) ** (n - count)
        if tail >= recall:
            return count
    return 0


def usable(vectors: list) -> tuple[list[int], list[np.ndarray]]:
    """Places and values of vectors that can link: not null or zero, all components finite."""
    places, values = [], []
    for i, v in enumerate(vectors):
        if v is None or any(x is None for x in v):
            continue
        x = np.array(v, np.float64)
        if len(x) and np.isfinite(x).all() and x.any():
            places.append(i)
            values.append(x)
    return places, values


def first_projection(rows: DataFrame, threshold: float) -> DataFrame:
    """``dim, cell`` of each usable vector: its cell on the first direction, as wide as any linked pair is apart."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values = usable(batch["embedding"].to_pylist())
            cells = []
            for x in values:
                # Scaled first, so that very large or small components don't overflow.
                x = x / np.abs(x).max()
                at = float(x @ directions_of(len(x))[:, 0]) / float(np.linalg.norm(x))
                cells.append(math.floor(at / (math.sqrt(2 - 2 * threshold) + 1e-12)))
            kept = batch.take(pa.array(places, pa.int64()))
            yield pa.record_batch(
                [*kept.columns, pa.array([len(x) for x in values], pa.int32()), pa.array(cells, pa.int32())],
                names=[*kept.schema.names, "dim", "cell"],
            )

    known: dict[int, np.ndarray] = {}

    def directions_of(dim: int) -> np.ndarray:
        if dim not in known:
            known[dim] = directions(dim)
        return known[dim]

    return rows.mapInArrow(project, "vec_id long, label long, embedding array<double>, salt long, dim int, cell int")


def link_block(table: pa.Table, threshold: float) -> pa.Table:
    """Links between the queries and the others of one pair of blocks: counts, and stars of linked vectors."""
    ids = table["vec_id"].to_numpy()
    x = np.array(table["embedding"].to_pylist(), np.float64)
    home = table["home"].to_numpy(zero_copy_only=False).astype(bool)
    side = table["side"].to_numpy()
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    dim = x.shape[1]
    points = x @ directions(dim)
    half, least = window(dim, threshold), least_collisions(dim, threshold)
    order = np.argsort(points, axis=0, kind="stable")
    ranked = np.take_along_axis(points, order, axis=0)
    n = len(ids)
    links = np.zeros(n, np.int64)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for q in np.flatnonzero(home & (side != 2)).tolist():
        counts = np.zeros(n, np.int16)
        for j in range(points.shape[1]):
            a, b = np.searchsorted(ranked[:, j], [points[q, j] - half, points[q, j] + half + 1e-15])
            counts[order[a:b, j]] += 1
        near = np.flatnonzero(counts >= least)
        if side[q] == 0:  # one block with itself: home pairs once
            near = near[~home[near] | (near > q)]
        else:  # two blocks: this one's home vectors with the other's
            near = near[side[near] == 2]
        near = near[near != q]
        found = near[x[near] @ x[q] >= threshold]
        links[q] += len(found)
        np.add.at(links, found, 1)
        for other in found.tolist():
            a, b = find(q), find(other)
            root[max(a, b)] = min(a, b)
    roots = [find(i) for i in range(n)]
    linked = np.flatnonzero(links)
    return pa.table(
        {
            "vec_id": pa.array(ids[linked], pa.int64()),
            "links": pa.array(links[linked], pa.int64()),
            "star": pa.array([ids[roots[i]] for i in linked.tolist()], pa.int64()),
        }
    )


def link(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors (``embedding``) are compared within a ``label`` and length by cosine. Linked vectors are
    at most ``sqrt(2 - 2 * threshold)`` apart on any direction, so cells of that width on the first
    direction meet only themselves and the next one. A cell is split into blocks by a hash, and each pair
    of blocks is one task, so neither a hot label nor a hot cell is gathered. In a task the
    projections are sorted, windows around each query are counted, and vectors that
    collide often enough (``least_collisions``) are verified. Tasks return counts and stars, not pairs.

    Null labels, null ids and vectors that are null, zero or hold null or non-finite components
    link with nothing and are listed. ``vec_id`` names a vector: rows that repeat an id share
    its links, counted for each of its rows. Without an id, ``component_id`` is null and ``kept`` false.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    able = rows.where("label IS NOT NULL AND vec_id IS NOT NULL").withColumn(
        "salt", F.xxhash64(F.lit(SEED), "vec_id")
    )
    placed = stored(first_projection(able, threshold), "projected")
    sizes = placed.groupBy("label", "dim", "cell").agg(F.count("*").alias("_n"))
    blocks = sizes.select("label", "dim", "cell", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_own"))
    near = blocks.select("label", "dim", (F.col("cell") - 1).alias("cell"), F.col("_own").alias("_next"))
    # Of each cell: its own blocks and those of the next cell, which join it as neighbours.
    shape = blocks.join(near, ["label", "dim", "cell"], "left").fillna(0, ["_next"])
    shape = shape.withColumn("_blocks", F.col("_own") + F.col("_next"))
    mine = placed.withColumn("home", F.lit(True))
    other = placed.withColumn("cell", F.col("cell") - 1).withColumn("home", F.lit(False))
    both = mine.unionByName(other).join(shape, ["label", "dim", "cell"])
    own = F.pmod("salt", F.when(F.col("home"), F.col("_own")).otherwise(F.col("_next")))
    block = own.cast("int") + F.when(F.col("home"), 0).otherwise(F.col("_own"))
    # A neighbour never meets another neighbour: that pair belongs to the next cell.
    met = both.withColumn("_b", block).withColumn(
        "_with", F.explode(F.expr("sequence(0, if(home, _blocks, _own) - 1)"))
    )
    met = met.select(
        "label", "dim", "cell",
        F.least("_b", "_with").alias("lo"), F.greatest("_b", "_with").alias("hi"),
        "vec_id", "embedding", "home",
        F.when(F.col("_b") == F.col("_with"), 0).when(F.col("_b") < F.col("_with"), 1).otherwise(2).alias("side"),
    )

    def run(table: pa.Table) -> pa.Table:
        return link_block(table, threshold)

    found = stored(
        met.groupBy("label", "dim", "cell", "lo", "hi").applyInArrow(run, "vec_id long, links long, star long"), "vector-links"
    )
    roots = components(found.select(F.col("vec_id").alias("a"), F.col("star").alias("b")))
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("_links"))
    linked = counts.join(roots, F.col("vec_id") == F.col("node"), "left").select(
        F.col("vec_id").alias("_id"), "_links", "root"
    )
    out = rows.select("vec_id").join(linked, F.col("vec_id") == F.col("_id"), "left")
    component = F.coalesce("root", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
