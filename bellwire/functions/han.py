"""Words of Chinese text, which has no spaces, by longest dictionary match.

Left to right, the longest known word at each place, else one character. A dictionary that tasks can hold is
matched against whole batches at once (:func:`segment`); a larger one is joined (:mod:`bellwire.operators.han_words`).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Characters of text that are matched at once: their arrays take some hundred bytes a character.
CHUNK_CHARS = 1 << 18
# Fixed value: runs of Chinese characters; other text is split at its separators.
PIECES = re.compile(r"([一-龥]+)|([^\W_一-龥]+)")


def segment(spark: SparkSession, text: Column, dictionary: list[str]) -> Column:
    """``array<string>`` of words; ``dictionary`` is a bounded list of known words.

    All Chinese runs of about ``CHUNK_CHARS`` characters of texts are one array of characters. For each length, the hashes of all places are looked up
    among the words of that length and what is found is compared. Which places begin a word follows by jumping
    from word to word, twice as far each round. The work is a few array operations per length and round, not
    one step per character. The helpers are defined in here so that they travel with the function: workers
    need not have this package installed.
    """
    words: dict[int, list[str]] = {}
    for word in sorted(set(dictionary)):
        if len(word) > 1:
            words.setdefault(len(word), []).append(word)
    # Per length: characters of its words, one row each.
    tables = {n: np.array([[ord(c) for c in w] for w in ws], np.uint32) for n, ws in words.items()}
    shared = spark.sparkContext.broadcast(tables)
    pieces, limit = PIECES, CHUNK_CHARS

    def hashes(chars: np.ndarray, n: int) -> np.ndarray:
        """A hash of the ``n`` characters from each place on; the last places have none."""
        total = np.zeros(max(0, len(chars) - n + 1), np.uint64)
        for j in range(n):
            total = (total ^ chars[j : j + len(total)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        return total

    def begins(runs: list[str]) -> np.ndarray:
        """The places in the joined runs at which a word begins."""
        sizes = np.array([len(r) for r in runs], np.int64)
        chars = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32)
        total = len(chars)
        ends = np.repeat(np.cumsum(sizes), sizes)
        length = np.ones(total, np.int64)
        for n, table in sorted(shared.value.items()):
            found = hashes(chars, n)
            known = hashes(table.ravel(), n)[::n]
            order = np.argsort(known, kind="stable")
            at = np.searchsorted(known[order], found)
            # Words of one hash stand next to one another.
            open_ = np.flatnonzero((at < len(order)) & (np.arange(len(found)) + n <= ends[: len(found)]))
            step = 0
            while len(open_):
                place = at[open_] + step
                inside = place < len(order)
                open_, place = open_[inside], place[inside]
                same = known[order[place]] == found[open_]
                open_, place = open_[same], place[same]
                equal = (table[order[place]] == chars[open_[:, None] + np.arange(n)]).all(axis=1)
                length[open_[equal]] = n
                open_, step = open_[~equal], step + 1
        # From word to word within a run; the place after the last character stands for the end of all runs.
        jump = np.append(np.minimum(np.arange(total) + length, total), total)
        mark = np.zeros(total + 1, bool)
        mark[np.cumsum(sizes) - sizes] = True
        for _ in range(int(sizes.max(initial=1)).bit_length()):
            mark[jump[np.flatnonzero(mark)]] = True
            jump = jump[jump]
        return np.flatnonzero(mark[:total])

    def split(lines: list[str | None]) -> list[list[str]]:
        found = [pieces.findall(line or "") for line in lines]
        runs = [han for line in found for han, _ in line if han]
        if not runs:
            return [[other for _, other in line] for line in found]
        joined, starts = "".join(runs), begins(runs)
        bounds = [*starts.tolist(), len(joined)]
        known = [joined[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        ends = np.searchsorted(starts, np.cumsum([len(r) for r in runs])).tolist()
        out, run, at = [], 0, 0
        for line in found:
            row: list[str] = []
            for han, other in line:
                if han:
                    row += known[at : ends[run]]
                    at, run = ends[run], run + 1
                else:
                    row.append(other)
            out.append(row)
        return out

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            # What is held at a time follows the characters of a chunk, not the rows of a batch.
            ends, start = texts.str.len().fillna(0).astype(np.int64).cumsum().to_numpy(), 0
            while start < len(texts):
                done = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
                yield pd.Series(split(texts.iloc[start:stop].tolist()), dtype=object)
                start = stop

    return cut(text)
