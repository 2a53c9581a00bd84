"""Cost-balanced packing of tokenised documents into fixed-length training sequences."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bellwire.llm import spans

SEQUENCE = 4096
END_ID = 2
# Text that goes into one packing group, in bytes. Groups are packed independently.
GROUP_BYTES = 4 << 20
# Groups that one task packs.
TASK_GROUPS = 8
# Words whose ids a task remembers at most, but for those of one chunk.
MEMORY = 1 << 18

# Relative costs of one token and of one attended pair of tokens.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)

# Fixed values of the vocabulary: how bytes are written as characters, and how words split.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+"
_PLAIN = r"[!-~À-ÖØ-öø-ÿ]+\Z"


class WordIds:
    """Token ids of words between white space, remembered per task.

    The vocabulary drops white space and never joins over it, so a text's ids are those of
    its words. Words of ASCII and Latin letters go straight to the merge table; all other
    words, and those that hold an added token's text, go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        # Words of letters alone hold no added token, unless one is made of letters.
        self.bare = not any(t.isalpha() for t in added)
        self.model = self.tokenizer.model
        rest = (b for b in range(256) if b not in set(_PRINTED))
        self.chars = {b: chr(b) for b in _PRINTED} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.split, self.plain = re.compile(_SPLIT), re.compile(_PLAIN)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.parts: dict[str, list[int]] = {}
        self.ids, self.starts = np.zeros(0, np.uint16), np.zeros(1, np.int64)
        self.again = np.zeros(0, bool)

    def thin(self) -> None:
        """Keeps the words that came again since they were learnt or last kept, if they are not too many."""
        slots = np.flatnonzero(self.again)
        if len(slots) > MEMORY // 2:
            self.forget()
            return
        lengths = (self.starts[1:] - self.starts[:-1])[slots]
        starts = np.concatenate(([0], np.cumsum(lengths)))
        self.ids = self.ids[np.repeat(self.starts[slots] - starts[:-1], lengths) + np.arange(starts[-1])]
        place = np.cumsum(self.again) - 1
        again = self.again.tolist()
        self.known = {w: int(place[s]) for w, s in self.known.items() if again[s]}
        self.starts, self.again, self.parts = starts, np.zeros(len(slots), bool), {}

    def word(self, text: str) -> list[int]:
        lower = text.lower()
        if self.bare and text.isascii() and text.isalpha():
            return self.part(lower)
        if not self.plain.match(text) or self.added.search(lower):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        parts = self.split.findall(lower)
        if len(parts) == 1:
            # Most new words are one part that comes once.
            return self.part(lower)
        out: list[int] = []
        for part in parts:
            ids = self.parts.get(part)
            if ids is None:
                ids = self.parts[part] = self.part(part)
            out += ids
        return out

    def part(self, part: str) -> list[int]:
        """Ids of a part in lower case. Printed ASCII stands for itself."""
        if not part.isascii():
            part = "".join([self.chars[b] for b in part.encode()])
        return [t.id for t in self.model.tokenize(part)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end id included, and where each text starts among them."""
        data, at = spans.text_bytes(texts)
        starts, ends, rows = spans.runs(data, at, spans.SPACED)
        # Distinct words by their bytes: those of all words, and where each word starts among them.
        offsets = np.concatenate(([0], np.cumsum(ends - starts)))
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[spans.SPACED[data]])]
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        words, inverse = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        if len(self.known) + len(words) > MEMORY:
            self.thin()
        slots = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        self.again[slots[slots >= 0]] = True
        new = np.flatnonzero(slots < 0)
        fresh = [words[i] for i in new.tolist()]
        learnt = [self.word(w.decode()) for w in fresh]
        slots[new] = np.arange(len(new)) + len(self.again)
        self.known.update(zip(fresh, slots[new].tolist()))
        lengths = np.fromiter(map(len, learnt), np.int64, len(learnt))
        flat = np.fromiter(chain.from_iterable(learnt), np.uint16, int(lengths.sum()))
        self.ids = np.concatenate((self.ids, flat))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(lengths)))
        self.again = np.concatenate((self.again, np.zeros(len(new), bool)))
        bounds = self.starts
        places = slots[inverse] if len(slots) else np.zeros(0, np.int64)
        lengths = bounds[places + 1] - bounds[places]
        n = len(at) - 1
        sizes = spans.row_sums(lengths, rows, n) + 1
        ends_at = np.cumsum(sizes)
        out = np.full(int(ends_at[-1]) if n else 0, END_ID, np.uint16)
        if len(places):
            before = np.cumsum(lengths) - lengths
            source = np.repeat(bounds[places] - before, lengths) + np.arange(int(lengths.sum()))
            # Every earlier text put one end id before these.
            target = np.arange(len(source)) + np.repeat(rows, lengths)
            out[target] = self.ids[source]
        return out, np.concatenate(([0], ends_at))


def sequence_caps(tokens: int, limit: int = SEQUENCE) -> list[int]:
    """Capacities that hold exactly ``tokens``: full sequences, the rest as powers of two."""
    rest = tokens % limit
    return [limit] * (tokens // limit) + [
        1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1
    ]


def balance(lengths: np.ndarray, limit: int = SEQUENCE) -> list[tuple[int, int, int, int]]:
    """Pieces (document, start, length, sequence) of documents shorter than ``limit``.

    Longest documents first, each whole into the cheapest sequence that still has room for
    it. What finds no room whole is cut over the room that is left, cheapest first. The
    capacities hold exactly all tokens, so nothing is padded.
    """
    caps = np.array(sequence_caps(int(lengths.sum()), limit), np.int64)
    cost = np.zeros(len(caps))
    pieces, left = [], []

    def put(doc: int, start: int, length: int, seq: int) -> None:
        pieces.append((doc, start, length, seq))
        caps[seq] -= length
        cost[seq] += LINEAR * length + QUADRATIC * length * length

    for doc in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[doc])
        fits = np.where(caps >= length, cost, np.inf)
        seq = int(np.argmin(fits)) if len(fits) else 0
        if np.isfinite(fits[seq]):
            put(doc, 0, length, seq)
        else:
            left.append(doc)
    for doc in left:
        start, length = 0, int(lengths[doc])
        while start < length:
            seq = int(np.argmin(np.where(caps > 0, cost, np.inf)))
            size = min(int(caps[seq]), length - start)
            put(doc, start, size, seq)
            start += size
    return pieces


def token_rows(docs: DataFrame, path: str, groups: int) -> DataFrame:
    """``doc_id, group, ids``: ids as unsigned 16-bit numbers; one row per document."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        for part in spans.chunks(batches, "text"):
            ids, at = words.encode(part["text"])
            raw = ids.tobytes()
            rows = [raw[2 * a : 2 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.record_batch(
                [part["doc_id"], part["group"], pa.array(rows, pa.binary())],
                names=["doc_id", "group", "ids"],
            )

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.pmod(F.xxhash64(F.lit(5), "doc_id", F.xxhash64("text")), F.lit(groups)).alias("group"),
    )
    return chosen.mapInArrow(encode, "doc_id long, group long, ids binary")


def pack_group(key: tuple, table: pa.Table) -> pa.Table:
    """All pieces of one group. Whole sequences are cut off long documents first."""
    # Ties are settled by the ids themselves, so that a second attempt packs alike.
    raw = table["ids"].to_pylist()
    doc_ids = table["doc_id"].to_pylist()
    order = sorted(range(len(raw)), key=lambda i: (doc_ids[i] is None, doc_ids[i] or 0, raw[i]))
    tokens = [np.frombuffer(raw[i], np.uint16).astype("<u4") for i in order]
    heads = [(d, s, SEQUENCE) for d, t in enumerate(tokens) for s in range(0, len(t) - SEQUENCE + 1, SEQUENCE)]
    skipped = np.array([len(t) // SEQUENCE * SEQUENCE for t in tokens], np.int64)
    rest = np.array([len(t) for t in tokens], np.int64) - skipped
    packed = [(d, int(skipped[d]) + s, n, q + len(heads)) for d, s, n, q in balance(rest) if n]
    pieces = [(d, s, n, q) for q, (d, s, n) in enumerate(heads)] + packed
    filled: dict[int, int] = {}
    rows = []
    for d, s, n, q in sorted(pieces, key=lambda p: (p[3], p[0], p[1])):
        offset = filled.get(q, 0)
        filled[q] = offset + n
        crc = zlib.crc32(tokens[d][s : s + n].tobytes())
        rows.append((doc_ids[order[d]], s, n, crc, len(tokens[d]), (key[0].as_py() << 32) + q, offset))
    names = [x.split()[0] for x in PIECES.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence of at most 4096 tokens.

    Documents (``doc_id``, ``text``, others ignored) are tokenised where they are, hashed into
    groups of about ``GROUP_BYTES`` of text and packed per group (``balance``). A document
    longer than a sequence first fills whole sequences alone, so a group's load never depends on
    how long one document is. Sequences of a group are full, but for a few whose lengths are
    powers of two. A null or empty text is its end id alone. Repeated rows are packed each;
    a null ``doc_id`` stays null; an empty table gives no rows.
    """
    bytes_ = docs.agg(F.sum(F.octet_length("text") + 1).alias("b")).first()["b"] or 0
    groups = max(1, -(-bytes_ // GROUP_BYTES))
    rows = token_rows(docs, tokenizer, groups)
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(max(least, -(-groups // TASK_GROUPS)), "group")
    return dealt.groupBy("group").applyInArrow(pack_group, PIECES)
