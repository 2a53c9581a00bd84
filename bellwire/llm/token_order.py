"""A global order of hashed tokens, frequent ones last, for prefix filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bellwire.llm import spans

# Tokens counted together inside a task, and the count from which a block reports a token.
BLOCK_TOKENS = 4 << 20
LEAST_IN_BLOCK = 6
# Frequent tokens that the order knows; all others count as rare. Joins are exact for any order.
KNOWN = 1 << 17
# Upper bits of a hash that lead to the known tokens with these bits, and how many of those are looked at one by one.
LEAD_BITS = 18
LEAD_STEPS = 8


@dataclass
class TokenOrder:
    """Frequent tokens (sorted hashes) and their frequency classes, at most ``KNOWN`` of them."""

    hashes: np.ndarray
    classes: np.ndarray

    @cached_property
    def starts(self) -> np.ndarray:
        """Where the tokens with each value of the upper bits begin in ``hashes``."""
        lead = self.hashes >> np.uint64(64 - LEAD_BITS)
        return np.searchsorted(lead, np.arange((1 << LEAD_BITS) + 1, dtype=np.uint64))

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The frequency class of each token: 0 for rare ones, else eighths of the count's logarithm."""
        found = np.zeros(len(hashes), np.uint16)
        if not len(self.hashes):
            return found
        last = len(self.hashes) - 1
        lead = (hashes >> np.uint64(64 - LEAD_BITS)).astype(np.int64)
        at = np.minimum(self.starts[lead], last)
        same = self.hashes[at] == hashes
        found = np.where(same, self.classes[at], found)
        left = np.flatnonzero(~same)
        at, end = at[left] + 1, self.starts[lead[left] + 1]
        for step in range(LEAD_STEPS):
            more = at < end
            left, at, end = left[more], at[more], end[more]
            if not len(left):
                return found
            same = self.hashes[at] == hashes[left]
            found[left[same]] = self.classes[at[same]]
            left, at, end = left[~same], at[~same] + 1, end[~same]
        at = np.minimum(np.searchsorted(self.hashes, hashes[left]), last)
        found[left] = np.where(self.hashes[at] == hashes[left], self.classes[at], np.uint16(0))
        return found


def frequent(blocks: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that stand ``least`` times or more in ``blocks``, ascending, and their counts. Empties ``blocks``.

    Sorted in place: besides the tokens themselves only what is frequent is held.
    """
    tokens = np.concatenate(blocks)
    blocks.clear()
    tokens.sort()
    if len(tokens) < least:
        return tokens[:0], np.zeros(0, np.int64)
    first = tokens[: len(tokens) - least + 1] == tokens[least - 1 :]
    first[1:] &= tokens[1 : len(first)] != tokens[: len(first) - 1]
    at = np.flatnonzero(first)
    found = tokens[at]
    return found, np.searchsorted(tokens, found, "right") - at


def token_order(
    docs: DataFrame, tokens: Callable[[pa.RecordBatch], np.ndarray], known: int = KNOWN
) -> TokenOrder:
    """Counts all tokens of all texts; ``tokens`` gives those of a chunk.

    Blocks of each task count exactly and report what is frequent in them; the reports are added
    up. The order decides how many candidates a join has to look at, never what it finds.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def report():
            found, times = frequent(held, LEAST_IN_BLOCK)
            return pa.record_batch([pa.array(spans.bit_equal(found)), pa.array(times)], names=["token", "n"])

        for part in spans.chunks(batches, "text"):
            held.append(tokens(part))
            size += len(held[-1])
            if size >= BLOCK_TOKENS:
                yield report()
                size = 0
        if held:
            yield report()

    counted = docs.select("text").mapInArrow(count, "token long, n long")
    top = counted.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(known)
    rows = top.toArrow()
    hashes = rows["token"].to_numpy().astype(np.int64).view(np.uint64)
    classes = (8 * np.log2(rows["n"].to_numpy().astype(np.float64))).astype(np.uint16) + np.uint16(1)
    at = np.argsort(hashes)
    return TokenOrder(hashes[at], classes[at])


def ordered_sets(
    hashes: np.ndarray, owners: np.ndarray, order: TokenOrder | None
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of each owner (ascending numbers), rare ones first, then by hash."""
    if (owners[1:] >= owners[:-1]).all():
        dense = np.concatenate(([0], np.cumsum(owners[1:] != owners[:-1]))) if len(owners) else owners
        several = int(dense[-1]) + 1 if len(dense) else 0
    else:
        distinct, dense = np.unique(owners, return_inverse=True)
        several = len(distinct)
    classes = order.of(hashes).astype(np.uint64) if order is not None else np.zeros(len(hashes), np.uint64)
    if several < 1 << 20:
        # One sort of numbers that hold the owner, the frequency class and the hash's upper bits.
        key = dense.astype(np.uint64) << np.uint64(44) | classes << np.uint64(35) | hashes >> np.uint64(29)
        at = np.argsort(key)
        # Unequal tokens of equal upper bits must stand in the same order in every set.
        tied = key[at[1:]] == key[at[:-1]]
        if (hashes[at[1:]][tied] != hashes[at[:-1]][tied]).any():
            at = np.lexsort((hashes, classes, dense))
    else:
        at = np.lexsort((hashes, classes, dense))
    hashes, owners = hashes[at], owners[at]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[new], owners[new]


def parities(tokens: np.ndarray, owners: np.ndarray, n: int, words: int) -> pa.ListArray:
    """For each of ``n`` owners, ``words`` numbers of 64 cells: the parity of how many of its tokens fall in each."""
    mixed = spans.mix(tokens)
    sign = np.zeros(n * words, np.uint64)
    word = (mixed >> np.uint64(6)) % np.uint64(words)
    np.bitwise_xor.at(sign, owners * words + word.astype(np.int64), np.uint64(1) << (mixed & np.uint64(63)))
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, len(sign) + 1, words, dtype=np.int32)), pa.array(spans.bit_equal(sign))
    )


def most_common(n: str, m: str, a: str, b: str, words: int) -> Column:
    """Upper bound of the overlap of sets of sizes ``n`` and ``m``: a cell of unequal parity holds a token of one side alone."""
    unequal = sum((F.bit_count(F.get(a, w).bitwiseXOR(F.get(b, w))) for w in range(words)), F.lit(0))
    return F.floor((F.col(n) + F.col(m) - unequal) / 2)


def first_common(n: str, m: str, i: str, j: str, percent: int) -> Column:
    """Whether places ``i`` and ``j`` can hold the first common token of sets that match.

    All common tokens stand from the first one on, on both sides, so what is left must hold the overlap needed.
    """
    return F.least(F.col(n) - F.col(i), F.col(m) - F.col(j)) >= needed(n, m, percent)


def needed(n: str, m: str, percent: int) -> Column:
    """The overlap from which sets of sizes ``n`` and ``m`` match."""
    return F.ceil((F.col(n) + F.col(m)) * percent / (100 + percent))
