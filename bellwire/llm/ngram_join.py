"""N-gram Jaccard join: prefix candidates, verified in tries of globally ordered n-gram sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bellwire.llm import spans
from bellwire.llm.graph import components
from bellwire.llm.token_order import TokenOrder, first_common, most_common, needed, ordered_sets, parities, token_order
from bellwire.operators.scans import global_row_number
from bellwire.session import small_side, stored

# Words of a shingle; documents link when 100 * intersection >= PERCENT * union.
WORDS = 4
PERCENT = 85
# Sets of one trie, and tokens of a node that are compared at once.
TRIE_SETS = 256
STEP = 64
# Numbers of 64 cells in a set's signature: the parity of how many of its tokens fall in each cell.
SIGN_WORDS = 16


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of each text: hashes and rows, rows ascending."""
    data, at = spans.text_bytes(texts)
    data = spans.lowered(data)
    starts, ends, rows = spans.runs(data, at, spans.SPACED)
    hashes = spans.span_hashes(data, starts, ends)
    grams, first = spans.gram_hashes(hashes, rows, k)
    gram_rows = rows[first]
    # Texts of fewer words than a shingle are one shingle, told apart by their length.
    counts = np.bincount(rows, minlength=len(at) - 1)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        begin = np.searchsorted(rows, short)
        whole = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            more = counts[short] > j
            at_j = np.minimum(begin + j, len(hashes) - 1)
            whole = np.where(more, spans.mix(whole * spans._BASE + hashes[at_j] + np.uint64(j + 101)), whole)
        grams, gram_rows = np.concatenate((grams, whole)), np.concatenate((gram_rows, short))
        by_row = np.argsort(gram_rows, kind="stable")
        grams, gram_rows = grams[by_row], gram_rows[by_row]
    return grams, gram_rows


def document_sets(docs: DataFrame, order: TokenOrder, k: int) -> DataFrame:
    """``doc_id, n, set_key, prefix, sign``: size and hash of each text's set, its prefix in the global order, its signature."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in spans.chunks(batches, "text"):
            tokens, rows = ordered_sets(*shingles(part["text"], k), order)
            n = part.num_rows
            sizes = np.bincount(rows, minlength=n)
            at = np.concatenate(([0], np.cumsum(sizes)))
            keys = np.zeros(n, np.uint64)
            np.add.at(keys, rows, spans.mix(tokens))
            lengths = np.where(sizes > 0, sizes + (-PERCENT * sizes // 100) + 1, 0)
            place = np.arange(len(tokens)) - at[rows]
            prefix = spans.bit_equal(tokens[place < lengths[rows]])
            bounds = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            yield pa.record_batch(
                [
                    part["doc_id"],
                    pa.array(sizes, pa.int64()),
                    pa.array(spans.bit_equal(keys)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(prefix)),
                    parities(tokens, rows, n, SIGN_WORDS),
                ],
                names=["doc_id", "n", "set_key", "prefix", "sign"],
            )

    kinds = "doc_id long, n long, set_key long, prefix array<long>, sign array<long>"
    return docs.select("doc_id", "text").mapInArrow(make, kinds)


def wide_sign(tokens: np.ndarray) -> bytes:
    """Parities of about as many cells as a set has tokens: which cells hold an odd number of them.

    The number of cells is a power of two, so that a signature folds onto a shorter one.
    """
    cells = 1 << max(10, int(len(tokens) - 1).bit_length()) if len(tokens) else 1 << 10
    at = (spans.mix(tokens) >> np.uint64(20)) & np.uint64(cells - 1)
    odd = np.bincount(at.astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def overlap_bound(n: int, m: int, x: bytes, y: bytes) -> int:
    """The most tokens that two sets can have in common: a cell of unequal parity holds a token of one side alone."""
    a, b = (np.frombuffer(v, np.uint64) for v in (x, y))
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return (n + m - int(np.bitwise_count(a ^ b).sum())) // 2


def chosen_sets(docs: DataFrame, nodes: DataFrame, order: TokenOrder, k: int) -> DataFrame:
    """``node, n, wide, tokens``: whole ordered sets of the documents in ``nodes`` only and their wide signatures, stored."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in spans.chunks(batches, "text"):
            tokens, rows = ordered_sets(*shingles(part["text"], k), order)
            at = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=part.num_rows))))
            sets = [tokens[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.record_batch(
                [
                    part["doc_id"], pa.array(np.diff(at), pa.int64()), pa.array([wide_sign(x) for x in sets], pa.binary()),
                    pa.array([x.tobytes() for x in sets], pa.binary()),
                ],
                names=["node", "n", "wide", "tokens"],
            )

    wanted = docs.join(small_side(nodes), F.col("doc_id") == F.col("node"), "left_semi")
    sets = wanted.select("doc_id", "text").mapInArrow(make, "node long, n long, wide binary, tokens binary")
    return stored(sets, "sets")


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose wide signatures leave room for the overlap that a link needs.

    A signature takes a bit per token, a set eight bytes: what only shares some tokens goes before sets are sent.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("n_a", "n_b", "wide_a", "wide_b"))
            most = [overlap_bound(*row) for row in zip(*columns)]
            n, m = (batch[c].to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            both = np.array(most, np.int64)
            open_ = pa.array(100 * both >= PERCENT * (n + m - both))
            yield pa.record_batch([batch["a"].filter(open_), batch["b"].filter(open_)], names=["a", "b"])

    signs = sets.select("node", "n", "wide").distinct()
    a, b = (signs.toDF(side, f"n_{side}", f"wide_{side}") for side in "ab")
    rows = pairs.select("a", "b").join(a, "a").join(b, "b")
    return stored(rows.mapInArrow(check, "a long, b long"), "possible")


class Trie:
    """Ordered sets as a trie of runs: sets that begin alike share the nodes of their beginning."""

    def __init__(self, sets: list[np.ndarray]):
        keys = [s.astype(">u8").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.sets = [sets[i] for i in self.order]
        self.shared = [0]
        for a, b in zip(self.sets, self.sets[1:]):
            n = min(len(a), len(b))
            other = np.flatnonzero(a[:n] != b[:n])
            self.shared.append(int(other[0]) if len(other) else n)

    def links(self, query: np.ndarray) -> list[int]:
        """Indices of the sets that link to ``query``.

        The overlap with a node's tokens is counted once for all sets below it. A subtree is left
        when even all tokens that remain on both sides would not make up the overlap that is needed.
        """
        by_hash = np.argsort(query)
        ranked = query[by_hash]
        n = len(query)
        found: list[int] = []
        stack = [(0, len(self.sets), 0, 0, 0)]
        while stack:
            low, high, depth, overlap, passed = stack.pop()
            sizes = [len(s) for s in self.sets[low:high]]
            stop = min(self.shared[low + 1 : high], default=sizes[0])
            one = self.sets[low]
            alive = True
            while depth < stop and alive:
                run = one[depth : min(stop, depth + STEP)]
                at = np.minimum(np.searchsorted(ranked, run), n - 1)
                places = by_hash[at[ranked[at] == run]]
                overlap += len(places)
                if len(places):
                    passed = int(places.max()) + 1
                depth += len(run)
                alive = any(self.reach(n, size, overlap, n - passed, size - depth) for size in set(sizes))
            if not alive:
                continue
            ended = low
            while ended < high and len(self.sets[ended]) == depth:
                if 100 * overlap >= PERCENT * (n + depth - overlap):
                    found.append(self.order[ended])
                ended += 1
            begin = ended
            for i in range(ended + 1, high + 1):
                if i == high or self.shared[i] <= depth:
                    if begin < i:
                        stack.append((begin, i, depth, overlap, passed))
                    begin = i
        return found

    @staticmethod
    def reach(n: int, size: int, overlap: int, left: int, right: int) -> bool:
        most = overlap + min(left, right)
        return 100 * most >= PERCENT * (n + size - most)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets link. Partners of one ``a`` meet it in tries of bounded size."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        now: tuple | None = None

        def flush() -> pa.RecordBatch:
            trie = Trie([np.frombuffer(t, np.uint64) for _, t in held])
            linked = [held[i][0] for i in trie.links(np.frombuffer(now[1], np.uint64))]
            return pa.record_batch(
                [pa.array([now[0]] * len(linked), pa.int64()), pa.array(linked, pa.int64())], names=["a", "b"]
            )

        for batch in batches:
            for a, b, a_set, b_set in zip(*(batch[c] for c in ("a", "b", "a_set", "b_set"))):
                a = a.as_py()
                if held and (a != now[0] or len(held) == TRIE_SETS):
                    yield flush()
                    held = []
                if now is None or now[0] != a:
                    now = (a, a_set.as_py())
                held.append((b.as_py(), b_set.as_py()))
        if held:
            yield flush()

    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    left_over = sets.join(small_side(nodes), "node", "left_semi")
    left = left_over.select(F.col("node").alias("a"), F.col("tokens").alias("a_set"))
    right = left_over.select(F.col("node").alias("b"), F.col("tokens").alias("b_set"))
    rows = pairs.select("a", "b").join(right, "b").join(left, "a")
    # A partner-rich ``a`` is split over tasks by adaptive execution; the sets aren't shuffled again for it.
    return stored(rows.sortWithinPartitions("a").mapInArrow(check, "a long, b long"), "links")


def jaccard_links(docs: DataFrame, k: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """All documents with their set (``doc_id, n, set_key``), and ``node, root`` of all linked ones.

    1. Equal sets become one class, named by its smallest id.
    2. A class emits its prefix: sets that link share a token of it. Tokens of one class alone drop out.
    3. Each token's smallest class meets the others first. What links at once, mostly copies of one text,
       becomes one component before any other pairs are made.
    4. Only classes of different components meet, at tokens that can be the first they have in common. Their
       signatures must leave room for the overlap that a link needs.
    5. Candidates are verified on whole sets in tries.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = token_order(docs, lambda part: shingles(part["text"], k)[0])
    all_sets = stored(document_sets(docs, order, k).withColumn("row", F.monotonically_increasing_id()), "document-sets")
    named_sets = all_sets.where("n > 0 AND doc_id IS NOT NULL")
    # Only names of sets move to find equal ones; their prefixes stay where they are.
    named_rows = named_sets.groupBy(F.col("set_key").alias("_key"), F.col("n").alias("_n"))
    copies = named_rows.agg(F.count("*").alias("_times"), F.min(F.struct("doc_id", "row")).alias("_first"))
    copies = small_side(copies.where("_times > 1").select("_key", "_n", F.col("_first.row").alias("_row")))
    tagged = named_sets.join(copies, (F.col("set_key") == F.col("_key")) & (F.col("n") == F.col("_n")), "left")
    classes = tagged.where("coalesce(_row = row, true)").select(F.col("doc_id").alias("node"), "n", "prefix", "sign")
    at = F.shiftleft("n", 32).bitwiseOR(F.col("i").cast("long")).alias("at")
    tokens = classes.select("node", "n", F.posexplode("prefix").alias("i", "token")).select("token", "node", at)
    n, i = F.shiftright("at", 32).alias("n"), F.col("at").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("i")
    # A token's classes pass by in order behind its smallest one; one that stands alone has no neighbour.
    ordered = Window.partitionBy("token").orderBy("node", "at")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    beside = F.coalesce(F.lag("node").over(ordered), F.lead("node").over(ordered))
    passed = tokens.withColumns(
        {"_beside": beside, "pivot": F.first("node").over(so_far), "_pivot_at": F.first("at").over(so_far)}
    )
    kept = ["token", "node", n, i, "pivot", F.shiftright("_pivot_at", 32).alias("pivot_n")]
    shared = stored(passed.where("_beside IS NOT NULL").select(*kept), "shared")
    stars = (
        shared.where("node <> pivot")
        .groupBy("pivot", "pivot_n", "node", "n")
        .agg(F.count("*").alias("common"))
        # A first pass for close copies only; what it leaves out is compared below.
        .where(length_ok("n", "pivot_n") & (10 * F.col("common") >= 0.5 * F.col("n")))
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    )
    first = links_of(docs, stored(stars, "stars"), order, k)
    groups_ = components(first)
    label = small_side(groups_)
    named = shared.join(label, "node", "left").select("token", "node", "n", "i", F.coalesce("root", "node").alias("root"))
    # Tokens that stand in one component alone have nothing left to compare.
    mixed = named.groupBy("token").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo <> _hi")
    rest = stored(named.join(mixed.select("token"), "token", "left_semi"), "rest")
    # Only a token that can be the first common one of a pair makes it. Signatures of fixed size, however long
    # a document is, bound its overlap before it is shuffled.
    left = small_side(rest.select("node").distinct())
    signs = classes.join(left, "node", "left_semi")
    marked = (
        rest.join(signs, ["node", "n"])
        .select("token", "node", "n", "i", F.get("prefix", F.col("i") - 1).alias("before"), "root", "sign")
        .repartition("token")
    )

    def side(k: str) -> DataFrame:
        return marked.select(*[F.col(c).alias(f"{c}_{k}") for c in ("token", "node", "n", "i", "before", "root", "sign")])

    pairs = (
        side("a")
        .join(
            side("b"),
            (F.col("token_a") == F.col("token_b"))
            & (F.col("node_a") < F.col("node_b"))
            & (F.col("root_a") != F.col("root_b"))
            & first_common("n_a", "n_b", "i_a", "i_b", PERCENT)
            # Equal tokens just before: this one is not the first in common.
            & F.coalesce(F.col("before_a") != F.col("before_b"), F.lit(True))
            & (most_common("n_a", "n_b", "sign_a", "sign_b", SIGN_WORDS) >= needed("n_a", "n_b", PERCENT)),
        )
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .distinct()
    )
    more = links_of(docs, stored(pairs, "pairs"), order, k)
    stars_of = groups_.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return all_sets, components(more.unionByName(stars_of))


def length_ok(a: str, b: str):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def links_of(docs: DataFrame, pairs: DataFrame, order: TokenOrder, k: int) -> DataFrame:
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = chosen_sets(docs, nodes, order, k)
    return verified(possible(pairs, sets), sets)


def join(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id`` of every document.

    Words stand between white space, A-Z are lower-cased. A document is the set of its distinct
    ``k``-word shingles, or its whole sequence of fewer words. A null or empty text, or one without
    words, has an empty set and links with nothing. ``class_id`` is the smallest id with an equal set,
    ``component_id`` the smallest that links reach. ``doc_id`` names a document: rows that repeat an id
    share its links; a null id links with nothing and its class and component are null.
    """
    all_sets, linked = jaccard_links(docs, k)
    first = all_sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("set_key", "n").agg(F.min("doc_id").alias("class_id"))
    rows = all_sets.select("doc_id", "n", "set_key").join(first, ["set_key", "n"], "left")
    classed = rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("class_id")), "doc_id").alias("class_id"))
    out = classed.join(small_side(linked), F.col("class_id") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", "class_id", F.coalesce("root", "class_id").alias("component_id"))


def own_ids(docs: DataFrame) -> DataFrame:
    """``_row, doc_id, text``: rows whose id stands for different texts get ids of their own, after all others.

    Repeated rows with one text keep one id, so that they stay or go together.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), "text")
    keys = rows.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("_hash"))
    mixed = keys.groupBy("doc_id").agg(F.min("_hash").alias("_lo"), F.max("_hash").alias("_hi")).where("_lo <> _hi")
    many = keys.join(small_side(mixed.select("doc_id")), "doc_id", "left_semi").distinct()
    named = stored(global_row_number(many, [F.col("doc_id"), F.col("_hash")], "_number"), "own-ids")
    if named.isEmpty():
        return rows
    last = keys.agg(F.max("doc_id")).first()[0]
    fresh = small_side(named.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"), "_number"))
    found = rows.join(fresh, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_h")), "left")
    return found.select("_row", F.coalesce(F.col("_number") + last, F.col("doc_id")).alias("doc_id"), "text")


def one_of_each(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that are first of their component, with their own columns.

    Rows without words are in no component and stay; so do rows without an id. Rows that repeat an id and a text stay or go
    together; of different texts with one id each is judged alone, and comes after all other rows.
    """
    rows = own_ids(docs)
    found = join(rows, k).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return rows.join(small_side(found), F.col("doc_id") == F.col("_gone"), "left_anti").select("_row.*")
