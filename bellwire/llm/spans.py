"""Words and lines of Arrow text columns as NumPy arrays, a bounded chunk at a time.

A chunk is a run of rows whose texts take about ``CHUNK_BYTES``; a longer text is a chunk
of its own. Texts are never cut, and a null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

# A-Z become a-z, all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes of words between white space: [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

# Bytes of words of letters, digits and non-ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once lower-cased
ALNUM = np.ones(256, bool)
ALNUM[:0x30] = ALNUM[0x3A:0x61] = ALNUM[0x7B:0x80] = False

_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))

# Masks of the first bytes of a number of eight.
_HEADS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def chunks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < len(ends):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each text starts (one more entry: the end)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    at = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if buffers[2] is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(buffers[2], np.uint8)[at[0] : at[-1]], at - at[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """``LOWER`` of each byte."""
    return data | ((data - np.uint8(65) < 26).view(np.uint8) << 5)


def spaced(data: np.ndarray) -> np.ndarray:
    """``SPACED`` of each byte."""
    return (data != 0x20) & (data - np.uint8(9) > 4)


def run_bounds(mask: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``mask``; runs end with their text."""
    if not len(mask):
        none = np.zeros(0, np.int64)
        return none, none
    bounds = [np.flatnonzero(mask[1:] != mask[:-1]) + 1]
    # A run ends and another starts where both sides of a text's edge belong to words.
    edges = np.unique(at[1:-1])
    edges = edges[(edges > 0) & (edges < len(mask))]
    bounds.append(np.repeat(edges[mask[edges] & mask[edges - 1]], 2))
    bounds.append(np.array([0] * bool(mask[0]) + [len(mask)] * bool(mask[-1]), np.int64))
    both = np.concatenate(bounds)
    both.sort(kind="stable")
    return both[::2], both[1::2]


def runs(
    data: np.ndarray, at: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that belong to words: starts, ends, row of each. Runs end with their text."""
    starts, ends = run_bounds(spaced(data) if inside is SPACED else inside[data], at)
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def line_runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines between line feeds, empty ones included: starts, ends, row of each."""
    feeds = np.flatnonzero(data == 10)
    starts = np.concatenate((at[:-1], feeds + 1))
    rows = np.concatenate((np.arange(len(at) - 1), np.searchsorted(at, feeds, "right") - 1))
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    last = np.concatenate((rows[1:] != rows[:-1], [True])) if len(rows) else np.zeros(0, bool)
    ends = np.where(last, at[rows + 1], np.concatenate((starts[1:] - 1, [0]))[: len(rows)])
    return starts, ends, rows


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a hash are even."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each span as little-endian numbers of eight, the last one padded with zeros, and where each span's begin."""
    sizes = ends - starts
    counts = np.maximum((sizes + 7) >> 3, 1)
    at = np.concatenate(([0], np.cumsum(counts)))
    place = np.arange(at[-1]) - np.repeat(at[:-1], counts)
    from_ = np.repeat(starts, counts) + 8 * place
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[np.minimum(from_, len(data))].view("<u8").ravel()
    left = np.repeat(sizes, counts) - 8 * place
    cut = np.flatnonzero(left < 8)
    words[cut] &= (np.uint64(1) << (8 * np.maximum(left[cut], 0)).astype(np.uint64)) - np.uint64(1)
    return words, at


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of each span, equal for equal bytes wherever they stand.

    Every eight bytes are mixed with their place before they are added up, so that no text has a known collision.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[starts].view("<u8").ravel()
    # Most spans end within their first eight bytes.
    words &= _HEADS[np.minimum(sizes, 8)]
    sums = mix(words ^ _PLACES[0])
    long_ = np.flatnonzero(sizes > 8)
    if len(long_):
        rest, at = span_words(data, starts[long_] + 8, ends[long_])
        place = np.arange(1, len(rest) + 1) - np.repeat(at[:-1], np.diff(at))
        sums[long_] += np.add.reduceat(mix(rest ^ mix(place.astype(np.uint64) * _BASE + _PLACES[1])), at[:-1])
    return mix(sums + sizes.astype(np.uint64) * _BASE)


def same_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, like: np.ndarray) -> bool:
    """Whether the bytes of each span are those of the span whose number ``like`` gives."""
    if not len(starts):
        return True
    if ((ends - starts) != (ends - starts)[like]).any():
        return False
    words, at = span_words(data, starts, ends)
    counts = np.diff(at)
    place = np.arange(len(words)) - np.repeat(at[:-1], counts)
    return bool((words == words[np.repeat(at[like], counts) + place]).all())


def gram_hashes(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k words that follow one another in one row, and the index of their first word."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(hashes) - k + 1
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = mix(total * _BASE + hashes[j : j + n] + np.uint64(j + 1))
    first = np.flatnonzero(rows[:n] == rows[k - 1 :])
    return total[first], first


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of integer values per row."""
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)


def bit_equal(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the signed longs that Spark knows."""
    return x.view(np.int64)
