"""Hard negatives by bounds along a spanning tree of anchors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bellwire.operators.scans import global_row_number
from bellwire.session import scratch_path, stored

# Components are multiplied by this and rounded down, so that scores are whole numbers.
SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# A negative's score lies between these percentages of the positive's score.
LOW, HIGH = 30, 90
# Anchors that go through the candidates together, and the most numbers their vectors hold.
SLICE_ROWS = 2048
SLICE_VALUES = 1 << 20
# Candidates that are scored together.
CHUNK = 1024
# Share of a depth's pairs from which all of them are scored at once.
DENSE = 0.1
# Components are held within this; products of norms below EXACT have exact sums in doubles.
LIMIT = float(1 << 62)
EXACT = float(1 << 52)
LONG = (1 << 63) - 1

TREE = "slice long, dim int, place int, parent int, edge double, vec_id long, label long, vector array<double>"


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the rows that take part."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(finite)


def whole(values: np.ndarray) -> np.ndarray:
    """Components as whole numbers, still in doubles."""
    return np.clip(np.floor(SCALE * np.clip(values, -LIMIT, LIMIT)), -LIMIT, LIMIT)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of the rows: their order, parents first, then each one's parent (a place in the order) and
    distance to it. The first is the root, the row next to the mean; places are ordered by depth.
    """
    n = len(x)
    squares = np.einsum("ij,ij->i", x, x)
    root = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    best, near = np.full(n, np.inf), np.full(n, root)
    depth, done = np.zeros(n, np.int64), np.zeros(n, bool)
    at = root
    for _ in range(n):
        done[at] = True
        distance = squares + squares[at] - 2 * (x @ x[at])
        closer = ~done & (distance < best)
        best[closer], near[closer] = distance[closer], at
        if done.all():
            break
        at = int(np.argmin(np.where(done, np.inf, best)))
        depth[at] = depth[near[at]] + 1
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    edges = np.linalg.norm(x[order] - x[near[order]], axis=1)
    return order, place[near[order]], edges


def trees(anchors: DataFrame) -> DataFrame:
    """Anchors of each slice with their place in the spanning tree of those of equal length, stored."""

    def build(table: pa.Table) -> pa.Table:
        x = np.array(table["embedding"].to_pylist(), np.float64).reshape(table.num_rows, table["dim"][0].as_py())
        x = whole(x)
        order, parents, edges = spanning_tree(x)
        chosen = table.take(pa.array(order))
        columns = {c: chosen[c] for c in ("slice", "dim", "vec_id", "label")}
        columns |= {
            "place": pa.array(np.arange(len(order)), pa.int32()),
            "parent": pa.array(parents, pa.int32()),
            "edge": pa.array(edges),
            "vector": pa.array(list(x[order]), pa.list_(pa.float64())),
        }
        return pa.table([columns[c] for c in names], names=names)

    names = [c.split()[0] for c in TREE.split(", ")]
    return stored(anchors.groupBy("slice", "dim").applyInArrow(build, TREE), "anchor-trees")


@dataclass
class Tree:
    """Anchors of one length, parents first, and where each depth starts."""

    ids: np.ndarray
    labels: np.ndarray
    parents: np.ndarray
    edges: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    levels: list[int]

    @staticmethod
    def of(table: pa.Table) -> dict[int, Tree]:
        """The trees of one slice by the length of their vectors."""
        found = {}
        for dim in sorted(set(table["dim"].to_pylist())):
            rows = table.filter(pc.equal(table["dim"], dim)).sort_by("place")
            parents = rows["parent"].to_numpy()
            depth = np.zeros(len(parents), np.int64)
            for i in range(1, len(parents)):
                depth[i] = depth[parents[i]] + 1
            x = np.array(rows["vector"].to_pylist(), np.float64).reshape(rows.num_rows, dim)
            levels = [*np.flatnonzero(np.diff(depth, prepend=-1)).tolist(), len(parents)]
            found[dim] = Tree(
                rows["vec_id"].to_numpy(), rows["label"].to_numpy(), parents, rows["edge"].to_numpy(),
                x, np.linalg.norm(x, axis=1), levels,
            )
        return found


@dataclass
class Windows:
    """Wanted scores: per anchor any number of windows of whole numbers, all of them kept to their best few."""

    low: np.ndarray
    high: np.ndarray
    same_label: bool
    keep: int


def exact(x: np.ndarray, y: np.ndarray) -> int:
    """An inner product of whole numbers of any size, held within the range of longs."""
    total = sum(int(a) * int(b) for a, b in zip(x.tolist(), y.tolist()))
    return max(-LONG, min(LONG, total))


def pair_scores(tree: Tree, rows: np.ndarray, c: np.ndarray, norms: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Exact scores of pairs of an anchor and a candidate."""
    large = tree.norms[rows] * norms[columns] >= EXACT
    out = np.zeros(len(rows), np.int64)
    plain = np.flatnonzero(~large)
    for a in range(0, len(plain), 1 << 16):
        some = plain[a : a + (1 << 16)]
        out[some] = np.rint(np.einsum("ij,ij->i", tree.vectors[rows[some]], c[columns[some]])).astype(np.int64)
    for i in np.flatnonzero(large).tolist():
        out[i] = exact(tree.vectors[rows[i]], c[columns[i]])
    return out


class Best:
    """The best candidates of each window seen so far, in bounded space."""

    def __init__(self, windows: Windows):
        self.windows = windows
        # Nothing below the floor of a window can still enter it.
        self.floor = windows.low.copy()
        self.group = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.vec = np.zeros(0, np.int64)

    def add(self, anchor: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        width = self.floor.shape[1]
        groups, scores, vecs = [self.group], [self.score], [self.vec]
        for w in range(width):
            fits = (score >= self.floor[anchor, w]) & (score <= self.windows.high[anchor, w])
            groups.append(anchor[fits] * width + w)
            scores.append(score[fits])
            vecs.append(vec[fits])
        group, score, vec = np.concatenate(groups), np.concatenate(scores), np.concatenate(vecs)
        order = np.lexsort((vec, -score, group))
        group, score, vec = group[order], score[order], vec[order]
        first = np.searchsorted(group, group)
        rank = np.arange(len(group)) - first
        kept = rank < self.windows.keep
        last = rank == self.windows.keep - 1
        flat = self.floor.reshape(-1)
        flat[group[last]] = np.maximum(flat[group[last]], score[last])
        self.group, self.score, self.vec = group[kept], score[kept], vec[kept]


def search(tree: Tree, best: Best, vec: np.ndarray, labels: np.ndarray, c: np.ndarray) -> int:
    """Adds what a chunk of candidates holds to ``best``; the number of pairs that were rescored.

    An anchor's score differs from its parent's by at most their distance times the candidate's norm. A pair is
    rescored only if that interval meets a window of the anchor at a place that can still enter it.
    """
    norms = np.linalg.norm(c, axis=1)
    # Rounding of bounds in doubles.
    slack = 1 + 1e-9 * norms * float(tree.norms.max(initial=0.0))
    low = np.empty((len(tree.ids), len(vec)))
    high = np.empty_like(low)
    anchors, scores, vecs = [], [], []
    rescored = 0
    for a, b in zip(tree.levels[:-1], tree.levels[1:]):
        level = np.arange(a, b)
        usable_pairs = (tree.labels[a:b, None] == labels[None, :]) == best.windows.same_label
        usable_pairs &= tree.ids[a:b, None] != vec[None, :]
        if a:
            most = tree.norms[a:b, None] * norms[None, :] + slack
            reach = tree.edges[a:b, None] * norms[None, :] + slack
            low[a:b] = np.maximum(low[tree.parents[a:b]] - reach, -most)
            high[a:b] = np.minimum(high[tree.parents[a:b]] + reach, most)
            wanted = np.zeros_like(usable_pairs)
            for w in range(best.floor.shape[1]):
                wanted |= (high[a:b] >= best.floor[a:b, w, None]) & (low[a:b] <= best.windows.high[a:b, w, None])
            wanted &= usable_pairs
        else:
            wanted = np.ones_like(usable_pairs)
        rows, columns = np.nonzero(wanted)
        if not len(rows):
            continue
        rescored += len(rows)
        if len(rows) > DENSE * wanted.size and tree.norms.max() * norms.max() < EXACT:
            score = np.rint((tree.vectors[a:b] @ c.T)[rows, columns]).astype(np.int64)
        else:
            score = pair_scores(tree, level[rows], c, norms, columns)
        low[level[rows], columns] = high[level[rows], columns] = score
        good = usable_pairs[rows, columns]
        anchors.append(level[rows[good]])
        scores.append(score[good])
        vecs.append(vec[columns[good]])
    best.add(np.concatenate(anchors), np.concatenate(scores), np.concatenate(vecs))
    return rescored


def found(candidates: DataFrame, slice_trees: dict[int, Tree], windows: dict[int, Windows]) -> DataFrame:
    """``dim, place, w, vec, score``: each task's best candidates for each window of the slice's anchors."""
    shared = candidates.sparkSession.sparkContext.broadcast((slice_trees, windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, wanted = shared.value
        best = {dim: Best(w) for dim, w in wanted.items()}
        for batch in batches:
            column = batch["embedding"]
            sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            vec, labels = batch["vec_id"].to_numpy(), batch["label"].to_numpy()
            ends = np.cumsum(sizes, dtype=np.int64)
            values = whole(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            for dim in set(sizes.tolist()) & set(best):
                at = np.flatnonzero(sizes == dim)
                for some in np.array_split(at, -(-len(at) // CHUNK)):
                    c = values[(ends[some] - dim)[:, None] + np.arange(dim)]
                    search(known[dim], best[dim], vec[some], labels[some], c)
        for dim, b in best.items():
            width = b.floor.shape[1]
            yield pa.record_batch(
                [
                    pa.array(np.full(len(b.group), dim), pa.int32()),
                    pa.array(b.group // width, pa.int32()),
                    pa.array(b.group % width, pa.int32()),
                    pa.array(b.vec, pa.int64()),
                    pa.array(b.score, pa.int64()),
                ],
                names=["dim", "place", "w", "vec", "score"],
            )

    parts = candidates.mapInArrow(run, "dim int, place int, w int, vec long, score long")
    ranked = Window.partitionBy("dim", "place", "w").orderBy(F.desc("score"), "vec")
    keep = next(iter(windows.values())).keep
    return parts.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= keep)


def negative_windows(tree: Tree, positives: pa.Table, count: int, keep: int, low: int, high: int) -> Windows:
    """The windows that each anchor's positives open; positives that are lacking open none."""
    lows = np.full((len(tree.ids), count), LONG, np.int64)
    highs = np.full((len(tree.ids), count), -LONG, np.int64)
    for place, w, score in zip(*(positives[c].to_pylist() for c in ("place", "rank", "score"))):
        a, b = -(-low * score // 100), high * score // 100
        if a <= b:
            lows[place, w - 1], highs[place, w - 1] = a, b
    return Windows(lows, highs, False, keep)


def mine(
    embeddings: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on ``vec_id``. Components become ``floor(256 * x)``; a score is the inner product, a
    whole number; higher scores come first, then smaller ids. An anchor's positives are its best rows of the same label.
    For each of them, the best rows of other labels follow whose score is ``low`` to ``high`` percent of the positive's.

    Anchors go in slices of a bounded size, in order of length and label, through all candidates, once for the
    positives and once for the negatives. A slice's spanning tree is built in one task; each task of candidates walks
    it from the root, bounds each anchor's scores by its parent's and rescores pairs that can still enter a window.
    Tasks return the best few rows of each window, so the shuffle doesn't grow with a label's or a copy's rows.

    Rows without an id, a label or a vector, or with a component that is null or not finite take no part. Vectors meet
    those of equal length only; a vector without components scores 0. A row is no partner of a row with its own id;
    otherwise repeated rows count one by one, and so do repeated anchors. Components beyond 2^62 after scaling and
    scores beyond the range of longs are held at its ends. An anchor without positives, or a positive whose score is negative or
    without partners, gives no rows; an empty table gives none. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    able = rows.where(is_anchor).withColumn("dim", F.size("embedding"))
    numbered = global_row_number(able, [F.col("dim"), F.col("label"), F.col("vec_id")], "_row")
    widest = able.agg(F.max("dim")).first()[0]
    per_slice = max(1, min(SLICE_ROWS, SLICE_VALUES // max(1, widest or 1)))
    planted = trees(numbered.withColumn("slice", F.floor((F.col("_row") - 1) / per_slice)).drop("_row"))
    out = scratch_path(spark, "hard-negatives")
    kinds = (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    last = planted.agg(F.max("slice")).first()[0]
    for s in range(-1 if last is None else last + 1):
        slice_ = planted.where(F.col("slice") == s).toArrow()
        known = Tree.of(slice_)
        every = {
            dim: Windows(np.full((len(t.ids), 1), -LONG), np.full((len(t.ids), 1), LONG), True, positives)
            for dim, t in known.items()
        }
        near = found(rows, known, every).select("dim", "place", "rank", "vec", "score").toArrow()
        windows = {
            dim: negative_windows(t, near.filter(pc.equal(near["dim"], dim)), positives, negatives, low, high)
            for dim, t in known.items()
        }
        chosen = {(r["dim"], r["place"], r["rank"]): (r["vec"], r["score"]) for r in near.to_pylist()}
        named = [
            (dim, place, w - 1, int(known[dim].ids[place]), vec, score) for (dim, place, w), (vec, score) in chosen.items()
        ]
        names = spark.createDataFrame(
            named, "dim int, place int, w int, anchor_id long, positive_id long, positive_score long"
        )
        hard = found(rows, known, windows).join(F.broadcast(names), ["dim", "place", "w"])
        hard.select(
            "anchor_id", "positive_id", "rank", F.col("vec").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        ).write.parquet(f"{out}/slice={s}")
    if last is None:
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(*[f"{out}/slice={s}" for s in range(last + 1)])
