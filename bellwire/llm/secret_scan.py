"""Secret scans: a trigram index of each block of texts picks the texts that a rule must read."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bellwire.llm import spans

try:
    from re import _constants as C
    from re import _parser as P
except ImportError:  # Python before 3.11
    import sre_constants as C
    import sre_parse as P

# A run of literals with more spellings than this is cut into parts.
SPELLINGS = 64


@dataclass(frozen=True)
class Rule:
    """``least`` characters are needed in ``group``; shorter matches are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = 0
    base: bool = False


# Kinds, patterns and least lengths.
RULES = [
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8, int(re.I | re.A), True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, base=True),
    Rule("hex", r"[0-9a-f]+", 0, 32, base=True),
    # The method's own.
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]


def trigram_query(pattern: str, flags: int = 0) -> frozenset[frozenset[bytes]]:
    """Clauses that every match fulfils: of each clause, all trigrams of one alternative.

    An alternative is a byte string of three or more lower-case characters; its trigrams are looked up.
    Without clauses the pattern has no mandatory trigram. Only plain ASCII literals count.
    """
    clauses: set[frozenset[bytes]] = set()

    def close(words: set[str]) -> set[str]:
        if all(len(w) >= 3 and w.isascii() for w in words):
            clauses.add(frozenset(w.lower().encode() for w in words))
        return {""}

    def letters(items) -> set[str] | None:
        out: set[str] = set()
        for op, value in items:
            if op is C.LITERAL:
                out.add(chr(value))
            elif op is C.RANGE and value[1] - value[0] < 4:
                out |= {chr(c) for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None

    def finite(seq) -> set[str] | None:
        """All strings of a part, or None if they are too many."""
        words = {""}
        for op, value in seq:
            more: set[str] | None = None
            if op is C.LITERAL:
                more = {chr(value)}
            elif op is C.IN:
                more = letters(value)
            elif op is C.SUBPATTERN:
                more = finite(value[3])
            elif op is C.BRANCH:
                parts = [finite(x) for x in value[1]]
                more = None if None in parts else set().union(*parts)
            elif op is C.MAX_REPEAT and value[1] == 1:
                more = finite(value[2])
                more = more if more is None or value[0] else more | {""}
            if more is None or len(words) * len(more) > SPELLINGS:
                return None
            words = {a + b for a in words for b in more}
        return words

    def walk(seq) -> None:
        words = {""}
        for item in seq:
            more = finite([item])
            if more is not None and len(words) * len(more) <= SPELLINGS:
                words = {a + b for a in words for b in more}
                continue
            words = close(words)
            op, value = item
            if more is not None:
                words = more
            elif op is C.SUBPATTERN:
                walk(value[3])
            elif op is C.MAX_REPEAT and value[0] >= 1:
                walk(value[2])
        close(words)

    walk(P.parse(pattern, flags))
    return frozenset(clauses)


def trigrams(word: bytes) -> list[int]:
    return [word[i] << 16 | word[i + 1] << 8 | word[i + 2] for i in range(len(word) - 2)]


class TrigramIndex:
    """Postings of a block of texts, for the trigrams that some rule asks for."""

    def __init__(self, rules: list[Rule]):
        self.queries = [trigram_query(r.pattern, r.flags) for r in rules]
        asked = {t for q in self.queries for clause in q for word in clause for t in trigrams(word)}
        self.asked = sorted(asked)
        self.slot = np.zeros(1 << 24, np.uint16)
        self.slot[self.asked] = np.arange(1, len(self.asked) + 1)

    def read(self, texts: pa.Array) -> None:
        data, at = spans.text_bytes(texts)
        data = spans.LOWER[data].astype(np.uint32)
        self.n = len(at) - 1
        self.postings: dict[int, np.ndarray] = {}
        if len(data) < 3:
            return
        slots = self.slot[data[:-2] << 16 | data[1:-1] << 8 | data[2:]]
        places = np.flatnonzero(slots)
        # A trigram over the end of a text only adds a text to be verified in vain.
        rows = np.searchsorted(at, places, "right") - 1
        pairs = np.unique(slots[places].astype(np.int64) * self.n + rows)
        which, row = pairs // self.n, pairs % self.n
        for i, t in enumerate(self.asked, 1):
            a, b = np.searchsorted(which, [i, i + 1])
            if a < b:
                self.postings[t] = row[a:b]

    def candidates(self, rule: int) -> np.ndarray:
        """Rows that may match: all of them if the rule has no mandatory trigram."""
        rows = np.arange(self.n)
        none = np.zeros(0, np.int64)
        for clause in self.queries[rule]:
            alternatives = []
            for word in sorted(clause):
                hit = None
                for t in trigrams(word):
                    found = self.postings.get(t, none)
                    hit = found if hit is None else np.intersect1d(hit, found, assume_unique=True)
                alternatives.append(hit)
            rows = np.intersect1d(rows, np.concatenate(alternatives))
        return rows


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``doc_id, spans``: kind, start and end (code points, end exclusive) of all secrets per text.

    Each task indexes its texts block by block, so texts never leave their row. A rule's mandatory
    trigrams are derived from its pattern (``trigram_query``); postings are intersected, and only the
    texts that remain are read with the pattern. A rule without mandatory trigrams reads all
    texts. Matches are leftmost and do not overlap within a kind; a match that is too short is
    dropped. A null text is empty; rows without secrets are listed with an empty array.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TrigramIndex(rules)
        patterns = []
        for rule, query in zip(rules, index.queries):
            pattern = rule.pattern
            if not query and not rule.group and rule.least > 1 and re.fullmatch(r"\[[^\]\\]+\]\+", pattern):
                # Runs of one class: runs that are too short need not be matched to be dropped.
                pattern = f"{pattern[:-1]}{{{rule.least},}}"
            patterns.append(re.compile(pattern, rule.flags))
        for part in spans.chunks(batches, "text"):
            index.read(part["text"])
            texts = part["text"]
            found: list[list] = [[] for _ in range(part.num_rows)]
            for r, (rule, pattern) in enumerate(zip(rules, patterns)):
                for row in index.candidates(r).tolist():
                    for m in pattern.finditer(texts[row].as_py() or ""):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            found[row].append((m.start(), r, m.end()))
            spans_ = [
                [{"kind": rules[r].kind, "start": a, "end": b} for a, r, b in sorted(x)] for x in found
            ]
            yield pa.record_batch([part["doc_id"], pa.array(spans_, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find, "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    )


def digest(found: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """The scan as one row of plain columns per document."""
    kinds = [r.kind for r in rules if r.base]

    def joined(spans_):
        return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[count(k) for k in kinds],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
