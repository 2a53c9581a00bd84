"""The prefix trie of conversations: adaptive radix trees over sorted blocks of keys, joined along their borders."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bellwire.session import small_side, stored

# Bytes of a turn's id; a conversation's key is the ids of its turns.
WIDTH = 16
# Keys that one tree holds, in bytes, and bytes of keys that one task reads.
BLOCK_BYTES = 4 << 20
TASK_BYTES = 32 << 20
# Ids of one piece of a key's list of conversations.
PIECE_IDS = 4096
# Conversations that share a first part, and the turns it may have, are fixed by the rebuilding rule.
FAMILY, TURNS = 5, 9
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- keys ---------------------------------------------------------------------


def turn_ids(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, id, n_bytes`` of each turn: its text stays behind, a digest of role and text is its id."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * WIDTH)).alias("id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    ).where("conv_id IS NOT NULL")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, key, sizes``: every conversation's turns after its first ones are replaced by its family's.

    The family of conversation c is c - c % 5, whose first crc32(c) % 9 turns c begins with. A family's turns meet in one
    row, so that rebuilding takes one exchange of ids. ``sizes`` holds a little-endian long of bytes per turn.
    """
    family = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family")
    rows = turns.groupBy(family).agg(F.collect_list(F.struct("conv_id", "turn", "role", "id", "n_bytes")).alias("said"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, sizes = [], [], []
            for family, said in zip(batch["family"].to_pylist(), batch["said"]):
                convs: dict[int, list] = {}
                for t in said.as_py():
                    convs.setdefault(t["conv_id"], []).append(
                        (t["turn"] is not None, t["turn"] or 0, t["role"], t["id"], t["n_bytes"])
                    )
                for own in convs.values():
                    own.sort()
                for conv, own in convs.items():
                    h = zlib.crc32(str(conv).encode()) % TURNS
                    made = convs.get(family, [])[:h] + own[h:]
                    ids.append(conv)
                    keys.append(b"".join(t[3] for t in made))
                    sizes.append(np.array([t[4] for t in made], "<i8").tobytes())
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.binary())],
                names=["conv_id", "key", "sizes"],
            )

    return rows.mapInArrow(run, "conv_id long, key binary, sizes binary")


def end_digests(convs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``digest, ends``: SHA-256 of the sorted ids of the conversations of each repeated key.

    The ids are sorted over all tasks, whichever key they have, and written out as pieces of text. A hash of one
    sequence has one reader, so a key's pieces come in order to one task and run through it.
    """
    ids = convs.select(F.md5("key").alias("digest"), "conv_id").join(repeated, "digest", "left_semi")
    ordered = ids.repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, convs_ = batch["digest"].to_pylist(), batch["conv_id"].to_pylist()
            rows: list[tuple] = []
            start = 0
            for at in range(1, len(digests) + 1):
                if at == len(digests) or digests[at] != digests[start] or at - start == PIECE_IDS:
                    rows.append((digests[start], convs_[start], ",".join(map(str, convs_[start:at]))))
                    start = at
            yield table(rows, [("digest", pa.string()), ("first", pa.int64()), ("piece", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("digest", pa.string()), ("ends", pa.string())]
        current, state = None, None
        for batch in batches:
            done = []
            for digest, piece in zip(batch["digest"].to_pylist(), batch["piece"].to_pylist()):
                if digest != current:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = digest, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            yield table(done, kinds)
        if state is not None:
            yield table([(current, state.hexdigest())], kinds)

    def table(rows: list[tuple], kinds: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(kinds)
        return pa.record_batch([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], names=[n for n, _ in kinds])

    pieces = ordered.mapInArrow(write, "digest string, first long, piece string")
    whole = pieces.repartition("digest").sortWithinPartitions("digest", "first")
    return whole.mapInArrow(read, "digest string, ends string")


def distinct_keys(convs: DataFrame) -> DataFrame:
    """``key, sizes, n, conv_id, ends`` of each distinct key: copies are added up before anything is sorted."""
    keys = convs.groupBy("key", "sizes").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    keys = stored(keys.withColumn("digest", F.md5("key")), "trie-keys")
    repeated = small_side(keys.where("n > 1").select("digest"))
    ends = end_digests(convs, repeated)
    alone = F.when(F.col("n") == 1, F.sha2(F.col("conv_id").cast("string"), 256))
    return keys.join(ends, "digest", "left").withColumn("ends", F.coalesce(alone, "ends")).drop("digest")


# --- adaptive radix tree --------------------------------------------------------


class Node:
    """A compressed path, the number of the key that ends after it (or None), then children by their next byte.

    Up to 4 and 16 children stand in sorted lists of bytes; up to 48 in a table of 256 places into a list; more
    in a list of 256. A node grows to the next layout when it is full.
    """

    __slots__ = ("path", "ends", "layout", "bytes", "kids")

    def __init__(self, path: bytes):
        self.path, self.ends, self.layout = path, None, 4
        self.bytes, self.kids = bytearray(), []

    def get(self, byte: int):
        if self.layout <= 16:
            at = self.bytes.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.layout == 48:
            at = self.bytes[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def put(self, byte: int, kid) -> None:
        """Sets or replaces the child at ``byte``."""
        if self.layout <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.kids[at] = kid
                return
            if len(self.kids) == self.layout:
                self.grow()
                self.put(byte, kid)
                return
            at = sum(1 for b in self.bytes if b < byte)
            self.bytes.insert(at, byte)
            self.kids.insert(at, kid)
        elif self.layout == 48:
            at = self.bytes[byte]
            if at:
                self.kids[at - 1] = kid
            elif len(self.kids) == 48:
                self.grow()
                self.put(byte, kid)
            else:
                self.kids.append(kid)
                self.bytes[byte] = len(self.kids)
        else:
            self.kids[byte] = kid

    def grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            places = bytearray(256)
            for at, byte in enumerate(self.bytes):
                places[byte] = at + 1
            self.layout, self.bytes = 48, places
        else:
            kids = [None] * 256
            for byte, at in enumerate(self.bytes):
                if at:
                    kids[byte] = self.kids[at - 1]
            self.layout, self.bytes, self.kids = 256, bytearray(), kids

    def children(self) -> list:
        """The children in order of their bytes."""
        if self.layout <= 16:
            return self.kids
        if self.layout == 48:
            return [self.kids[at - 1] for at in self.bytes if at]
        return [kid for kid in self.kids if kid is not None]


def common(a: bytes, b: bytes) -> int:
    """The length of the first part that two byte strings share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        half = (low + n) // 2
        if a[low:half] == b[low:half]:
            low = half
        else:
            n = half
    return low


class RadixTree:
    """An adaptive radix tree of distinct byte strings; one may be the first part of another."""

    def __init__(self) -> None:
        self.root: Node | None = None

    def insert(self, key: bytes, at: int) -> None:
        if self.root is None:
            self.root = Node(b"")
        node, depth = self.root, 0
        parent, branch = None, 0
        while True:
            shared = common(node.path, key[depth : depth + len(node.path)])
            if shared < len(node.path):
                # The path is split where the key leaves it.
                upper = Node(node.path[:shared])
                upper.put(node.path[shared], node)
                node.path = node.path[shared + 1 :]
                parent.put(branch, upper)
                node = upper
            depth += shared
            if depth == len(key):
                node.ends = at
                return
            kid = node.get(key[depth])
            if kid is None:
                kid = Node(key[depth + 1 :])
                kid.ends = at
                node.put(key[depth], kid)
                return
            parent, branch = node, key[depth]
            node, depth = kid, depth + 1


# --- nodes of one block -----------------------------------------------------------


# What a block knows of a trie node: its members here, those of its subtree's nodes that lie in this block alone, and for
# nodes on the paths of the block's first and last key, which other blocks may share, who they are and where they stand.
PART = (
    "path string, above string, depth long, n_bytes long, n long, conv_id long, parent_conv long, "
    "kids long, leaves long, saved long, ends string, first_at long, last_at long"
)


def prefix_digests(key: bytes) -> list[str]:
    """A digest of each whole-turn prefix of a key, from none on."""
    state = hashlib.md5()
    found = [state.hexdigest()]
    for at in range(0, len(key), WIDTH):
        state.update(key[at : at + WIDTH])
        found.append(state.copy().hexdigest())
    return found


def block_nodes(keys: list, sizes: list, counts: list, convs: list, ends: list, block: int) -> list[list]:
    """Rows of ``PART`` for all trie nodes of sorted distinct keys, from one radix tree.

    The tree is walked from the bottom. Only byte depths that are whole turns give nodes; a compressed path may hold
    several of them, or none. Nodes on the path of the first or the last key have a ``path`` and sums of the complete
    nodes below them; all others are complete.
    """
    tree = RadixTree()
    for i, key in enumerate(keys):
        tree.insert(key, i)
    left, right = prefix_digests(keys[0]), prefix_digests(keys[-1])
    rows: list[list] = []
    # Nodes to walk, with the bytes above their path; what is known below the nodes that are done.
    stack: list[tuple[Node, int, bool]] = [(tree.root, 0, False)]
    done: list[tuple] = []
    while stack:
        node, above, walked = stack.pop()
        depth = above + len(node.path)
        kids = node.children()
        if not walked:
            stack.append((node, above, True))
            stack.extend((kid, depth + 1, False) for kid in reversed(kids))
            continue
        below = done[len(done) - len(kids) :]
        del done[len(done) - len(kids) :]
        n, leaves, saved = (sum(b[i] for b in below) for i in range(3))
        open_rows = [row for b in below for row in b[3]]
        conv, at = min((b[4] for b in below), default=None), below[0][5] if below else None
        end = None
        if node.ends is not None:
            at = node.ends
            n, end = n + counts[at], ends[at]
            conv = convs[at] if conv is None else min(conv, convs[at])
        first, last = -(-above // WIDTH), depth // WIDTH
        if first <= last:
            lengths = np.frombuffer(sizes[at], "<i8")
            on_left, on_right = common(keys[0], keys[at]), common(keys[-1], keys[at])
        # Whole turns on the way from the parent's depth to this node's, deepest first.
        for d in range(last, first - 1, -1):
            ended = end if d * WIDTH == depth else None
            n_bytes = int(lengths[d - 1]) if d else 0
            row = [None, None, d, n_bytes, n, conv, None, len(open_rows), leaves, saved, ended, None, None]
            is_left, is_right = d * WIDTH <= on_left, d * WIDTH <= on_right
            if is_left or is_right:
                digests = left if is_left else right
                row[0], row[1] = digests[d], digests[d - 1] if d else None
                row[11], row[12] = 2 * block + (not is_left), 2 * block + is_right
                for child in open_rows:
                    rows[child][1] = row[0]
                open_rows = []
            else:
                for child in open_rows:
                    rows[child][6] = conv
                if not open_rows:
                    leaves = row[8] = leaves + 1
                saved = row[9] = saved + (n - 1) * n_bytes
                open_rows = [len(rows)]
            rows.append(row)
        done.append((n, leaves, saved, open_rows, conv, at))
    return rows


def block_parts(keys: DataFrame) -> DataFrame:
    """Rows of ``PART`` of sorted keys, a tree per ``BLOCK_BYTES``; stored."""
    size = keys.agg(F.sum(F.octet_length("key") + F.octet_length("sizes"))).first()[0] or 0
    cores = keys.sparkSession.sparkContext.defaultParallelism
    parts = int(max(cores, -(-size // TASK_BYTES)))
    ordered = keys.repartitionByRange(parts, "key").sortWithinPartitions("key")
    ordered = ordered.withColumn("part", F.spark_partition_id())
    columns = ["key", "sizes", "n", "conv_id", "ends"]
    names = [c.split()[0] for c in PART.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in columns]
        size, block = 0, 0

        def report(part: int) -> Iterator[pa.RecordBatch]:
            rows = block_nodes(*held, (part << 31) + block)
            for at in range(0, len(rows), 10_000):
                some = list(zip(*rows[at : at + 10_000]))
                kinds = [pa.string() if c in ("path", "above", "ends") else pa.int64() for c in names]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(some, kinds)], names=names)

        part = 0
        for batch in batches:
            part = batch["part"][0].as_py() if batch.num_rows else part
            for row in zip(*(batch[c].to_pylist() for c in columns)):
                for values, value in zip(held, row):
                    values.append(value)
                size += len(row[0]) + len(row[1])
                if size >= BLOCK_BYTES:
                    yield from report(part)
                    held, size, block = [[] for _ in columns], 0, block + 1
        if held[0]:
            yield from report(part)

    return stored(ordered.mapInArrow(run, PART), "trie-parts")


# --- the whole trie -----------------------------------------------------------------


def running_sums(totals: DataFrame) -> DataFrame:
    """``at`` with the sums of ``leaves`` and ``saved`` up to it: inside runs of places, then over the runs' totals."""
    run = F.shiftright("at", 17)
    inner = Window.partitionBy("run").orderBy("at")
    placed = totals.withColumn("run", run)
    names = ("leaves", "saved")
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sorting task or 65,536 blocks.
    whole = placed.groupBy("run").agg(*[F.sum(c).alias(c) for c in names])
    offsets = whole.select("run", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in names])
    summed = placed.select("run", "at", *[F.sum(c).over(inner).alias(c) for c in names]).join(offsets, "run")
    return summed.select("at", *[(F.col(c) + F.col(f"_{c}")).alias(f"{c}_upto") for c in names])


def border_nodes(parts: DataFrame) -> DataFrame:
    """Nodes that several blocks may share, put together: ``PART`` with whole sums, ``kids`` and ``parent_conv``.

    The first and last keys of all blocks stand in one order. A node covers a run of them, and is first seen at one of
    them. Nodes first seen later in its run lie below it, and so do deeper ones first seen with it: sums over a
    subtree are differences of running sums, however deep the trie is.
    """
    shared = parts.where("path IS NOT NULL").groupBy("path", "above", "depth", "n_bytes").agg(
        *[F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")],
        F.min("conv_id").alias("conv_id"),
        F.max("ends").alias("ends"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )
    shared = stored(shared, "trie-borders")
    more = shared.where("above IS NOT NULL").groupBy(F.col("above").alias("path")).agg(F.count("*").alias("_more"))
    nodes = shared.join(more, "path", "left").withColumn("kids", F.col("kids") + F.coalesce("_more", F.lit(0)))
    own = {"own_leaves": (F.col("kids") == 0).cast("long"), "own_saved": (F.col("n") - 1) * F.col("n_bytes")}
    nodes = nodes.drop("_more").withColumns(own)
    totals = nodes.select(F.col("first_at").alias("at"), F.col("own_leaves").alias("leaves"), F.col("own_saved").alias("saved"))
    ends = nodes.select(F.col("last_at").alias("at"), F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    upto = totals.unionAll(ends).groupBy("at").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    upto = stored(running_sums(upto), "trie-sums")
    from_, to = (upto.select([F.col(c).alias(f"{c}_{side}") for c in upto.columns]) for side in "ab")
    deeper = Window.partitionBy("first_at").orderBy(F.desc("depth"))
    nodes = nodes.withColumns({f"{c}_in": F.sum(f"own_{c}").over(deeper) for c in ("leaves", "saved")})
    nodes = nodes.join(from_, F.col("first_at") == F.col("at_a")).join(to, F.col("last_at") == F.col("at_b"))
    for c in ("leaves", "saved"):
        nodes = nodes.withColumn(c, F.col(c) + F.col(f"{c}_in") + F.col(f"{c}_upto_b") - F.col(f"{c}_upto_a"))
    parents = shared.select(F.col("path").alias("above"), F.col("conv_id").alias("parent_conv"))
    return nodes.join(parents, "above", "left")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per trie node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Conversations are rebuilt (``rebuilt``) and become keys of fixed-width big-endian turn ids, 16 bytes of the SHA-256
    of role and text; equal ids count as equal turns. Copies are added up first. The distinct keys are sorted over
    tasks and cut into blocks of a bounded size, each with its own radix tree. A node that only one block knows is
    complete there; those on a block's borders are put together by their digests, a few per block.

    Turns are ordered by ``turn``, nulls first, then by role and id, so that ties have one order; repeated rows are turns of
    their own. A null role or text is empty. Rows without ``conv_id`` belong to no conversation. A rebuilt conversation
    without turns ends at the root. An empty table gives no rows, not even a root. Other columns are ignored. A conversation's ids
    (24 bytes a turn) stand in one row; its texts don't.
    """
    convs = stored(rebuilt(turn_ids(conversations)), "trie-convs")
    parts = block_parts(distinct_keys(convs))
    border = stored(border_nodes(parts), "trie-border-nodes")
    names = small_side(border.select(F.col("path").alias("above"), F.col("conv_id").alias("_parent")))
    inner = parts.where("path IS NULL")
    known = inner.where("above IS NULL")
    below = inner.where("above IS NOT NULL").drop("parent_conv").join(names, "above", "left")
    columns = ["conv_id", "depth", "parent_conv", "n", "kids", "leaves", "saved", "ends"]
    whole = (
        border.select(columns)
        .unionAll(known.select(columns))
        .unionAll(below.withColumnRenamed("_parent", "parent_conv").select(columns))
    )
    return whole.select(
        "conv_id",
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
