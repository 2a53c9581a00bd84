"""Chinese words by a dictionary of any size: the longest known word at each place, else one character.

Words that tasks can hold are matched against chunks of texts at once; more words than that are joined with the texts' places.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bellwire.session import is_small, settled

# Functions that run inside tasks travel with the job: workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Runs of Chinese characters, and the first and last of these.
RUN = "([一-龥]+)"
FIRST, LAST = ord("一"), ord("龥")
# Characters of text that are matched at once: their arrays take some hundred bytes a character.
CHUNK_CHARS = 1 << 18
# Bits of a word's hash by which most places that begin no word are passed over.
SIEVE_BITS = 20


def han_runs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, run_no, run``: the runs of Chinese characters of each text, in order."""
    runs = docs.select(key, F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(1)).alias("_runs"))
    return runs.select(key, F.posexplode_outer("_runs").alias("run_no", "run")).where("run IS NOT NULL")


def word_tables(dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``word`` of two characters or more; ``head, sizes``: the lengths of the words that begin with two characters."""
    words = settled(dictionary.select("word").where(F.char_length("word") > 1).distinct())
    sized = words.select(F.substring("word", 1, 2).alias("head"), F.char_length("word").alias("n"))
    return words, settled(sized.groupBy("head").agg(F.collect_set("n").alias("sizes")))


def longest_matches(runs: DataFrame, words: DataFrame, heads: DataFrame, key: str) -> DataFrame:
    """``key, run_no, at, n``: the length of the longest word of two characters or more at each place that has one.

    The first two characters of a place say which lengths are worth a look; what they leave is joined with the words
    themselves. For dictionaries too large to be broadcast: places move, with no more of their run than the longest word.
    """
    longest = heads.select(F.max(F.array_max("sizes"))).first()[0] or 0
    places = runs.where(F.char_length("run") > 1).select(
        key, "run_no", "run", F.explode(F.sequence(F.lit(1), F.char_length("run") - 1)).alias("at")
    )
    near = places.select(
        key, "run_no", "at", F.col("run").substr(F.col("at"), F.lit(2)).alias("head"),
        F.col("run").substr(F.col("at"), F.lit(longest)).alias("near"),
    )
    tried = near.join(heads, "head").select(key, "run_no", "at", "near", F.explode("sizes").alias("n"))
    tried = tried.where(F.char_length("near") >= F.col("n"))
    named = tried.select(key, "run_no", "at", "n", F.col("near").substr(F.lit(1), F.col("n")).alias("word"))
    return named.join(words, "word", "left_semi").groupBy(key, "run_no", "at").agg(F.max("n").alias("n"))


def numbered(words: DataFrame) -> tuple[dict[int, tuple], DataFrame]:
    """What tasks need to find ``words``, by length: their hashes, characters and numbers; and ``id, word`` of all words and characters.

    A character by itself is a word whose number is its code; the numbers of longer words come after these.
    """
    known = sorted(r["word"] for r in words.collect())
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(known):
        by_length.setdefault(len(word), []).append(i)
    tables = {}
    for n, mine in sorted(by_length.items()):
        chars = np.frombuffer("".join(known[i] for i in mine).encode("utf-32-le"), np.uint32).reshape(-1, n)
        found = np.zeros(len(mine), np.uint64)
        for j in range(n):
            found = mixed(found, chars[:, j])
        order = np.argsort(found, kind="stable")
        sieve = np.zeros(1 << SIEVE_BITS, bool)
        sieve[found >> np.uint64(64 - SIEVE_BITS)] = True
        tables[n] = sieve, found[order], chars[order], (np.array(mine, np.int32) + LAST + 1)[order]
    ids = pa.array([*range(FIRST, LAST + 1), *range(LAST + 1, LAST + 1 + len(known))], pa.int32())
    named = pa.table([ids, pa.array([*map(chr, range(FIRST, LAST + 1)), *known], pa.string())], names=["id", "word"])
    return tables, words.sparkSession.createDataFrame(named)


def mixed(hashes: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Hashes of one character more."""
    out = (hashes ^ chars.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    return out


def longest(chars: np.ndarray, ends: np.ndarray, tables: dict[int, tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Length and number of the longest word at each place of joined runs; ``ends`` has where the place's run ends."""
    length, ids = np.ones(len(chars), np.int32), chars.astype(np.int32)
    hashes, done = np.zeros(len(chars), np.uint64), 0
    for n, (sieve, known, letters, numbers) in sorted(tables.items()):
        if n > len(chars):
            break
        while done < n:
            hashes = mixed(hashes[: len(chars) - done], chars[done:])
            done += 1
        open_ = np.flatnonzero(sieve[hashes >> np.uint64(64 - SIEVE_BITS)])
        open_ = open_[open_ + n <= ends[open_]]
        place = np.searchsorted(known, hashes[open_])
        # Words of one hash stand next to one another.
        while len(open_):
            inside = place < len(known)
            open_, place = open_[inside], place[inside]
            same = known[place] == hashes[open_]
            open_, place = open_[same], place[same]
            equal = (letters[place] == chars[open_[:, None] + np.arange(n)]).all(axis=1)
            length[open_[equal]] = n
            ids[open_[equal]] = numbers[place[equal]]
            open_, place = open_[~equal], place[~equal] + 1
    return length, ids


def begins(length: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places in joined runs at which a word begins, from the length of the longest word at each place."""
    total = len(length)
    jump = np.append(np.minimum(np.arange(total) + length, total), total)
    mark = np.zeros(total + 1, bool)
    mark[np.cumsum(sizes) - sizes] = True
    for _ in range(int(sizes.max(initial=1)).bit_length()):
        mark[jump[np.flatnonzero(mark)]] = True
        jump = jump[jump]
    return np.flatnonzero(mark[:total])


def words_of(texts: list[str], tables: dict[int, tuple]) -> tuple[np.ndarray, ...]:
    """Number of its text, number of its run there, place in the run from 1, and number of each word."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    chinese = (codes >= FIRST) & (codes <= LAST)
    # The line break after each text ends its last run.
    edges = np.flatnonzero(np.diff(chinese, prepend=False))
    starts, sizes_of_runs = edges[::2], edges[1::2] - edges[::2]
    text = np.searchsorted(np.cumsum(sizes), starts, "right")
    number = np.arange(len(text)) - np.searchsorted(text, text, "left")
    ends = np.cumsum(sizes_of_runs)
    length, ids = longest(codes[chinese], np.repeat(ends, sizes_of_runs), tables)
    found = begins(length, sizes_of_runs)
    run = np.repeat(np.arange(len(text)), sizes_of_runs)[found]
    return text[run], number[run].astype(np.int32), (found - (ends - sizes_of_runs)[run] + 1).astype(np.int32), ids[found]


def found_in_place(docs: DataFrame, words: DataFrame, key: str, text: str) -> DataFrame:
    """``key, run_no, at, word`` of whole texts, a chunk of characters at a time: nothing is shuffled, and no place is a row.

    Tasks hold the words as arrays and give each word's number; what is a word by that number is broadcast.
    """
    tables, names = numbered(words)
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(x or b"").decode("utf-8", "replace") for x in batch["_text"].to_pylist()]
            # What is held at a time follows the characters of a chunk, not the rows of a batch.
            ends, start = np.cumsum([len(t) for t in texts], dtype=np.int64), 0
            while start < len(texts):
                done = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + CHUNK_CHARS, "right")))
                source, run_no, at, ids = words_of(texts[start:stop], shared.value)
                yield pa.record_batch(
                    [batch[key].take(pa.array(source + start)), pa.array(run_no), pa.array(at), pa.array(ids)],
                    names=[key, "run_no", "at", "id"],
                )
                start = stop

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, F.col(text).cast("binary").alias("_text")).mapInArrow(run, f"`{key}` {kind}, run_no int, at int, id int")
    return rows.join(F.broadcast(names), "id").select(key, "run_no", "at", "word")


def leftmost(matches: DataFrame, key: str) -> DataFrame:
    """The matches that are taken from left to right: each begins where the one taken before has ended, or later.

    A run's matches pass by in order, and nothing but the last end is remembered, so a run may be as long as it likes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, end = None, 0
        for batch in batches:
            taken = []
            rows = zip(batch[key].to_pylist(), batch["run_no"].to_pylist(), batch["at"].to_pylist(), batch["n"].to_pylist())
            for doc, run_no, at, n in rows:
                if here != (doc, run_no):
                    here, end = (doc, run_no), 0
                taken.append(at >= end)
                if at >= end:
                    end = at + n
            yield batch.filter(pa.array(taken))

    ordered = matches.repartition(key, "run_no").sortWithinPartitions(key, "run_no", "at")
    return ordered.mapInArrow(run, matches.schema)


def han_words(docs: DataFrame, dictionary: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, run_no, at, word``: every Chinese word of each text; ``at`` counts characters of its run from 1.

    ``dictionary`` has a column ``word``. A null text, or one without Chinese characters, has no words. Keys are
    distinct; a null key has no words. Word tables that were measured small are broadcast and words are found where the
    texts are; with larger ones, places move to the words and back to their runs.
    """
    keyed = docs.where(F.col(key).isNotNull())
    runs = han_runs(keyed, key, text)
    words, heads = word_tables(dictionary)
    if is_small(words) and is_small(heads):
        return found_in_place(keyed, words, key, text)
    taken = leftmost(longest_matches(runs, words, heads, key), key)
    per_run = taken.groupBy(key, "run_no").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("_taken"))
    none = F.array().cast("array<struct<at: int, n: int>>")
    whole = runs.join(per_run, [key, "run_no"], "left").withColumn("_taken", F.coalesce("_taken", none))
    # Between two words, and after the last one, each character is a word.
    last = F.struct((F.char_length("run") + 1).alias("at"), F.lit(0).alias("n"))
    marked = whole.withColumn("_marks", F.concat("_taken", F.array(last)))
    places = F.transform(
        "_marks",
        lambda m, i: F.struct(
            F.when(i == 0, 1).otherwise(F.get("_marks", i - 1)["at"] + F.get("_marks", i - 1)["n"]).alias("free"),
            m["at"].alias("at"), m["n"].alias("n"),
        ),
    )
    singles = F.transform(
        places,
        lambda p: F.concat(
            F.when(p["at"] > p["free"], F.transform(F.sequence(p["free"], p["at"] - 1), lambda j: F.struct(j.alias("at"), F.lit(1).alias("n"))))
            .otherwise(none),
            F.when(p["n"] > 0, F.array(F.struct(p["at"].alias("at"), p["n"].alias("n")))).otherwise(none),
        ),
    )
    rows = marked.select(key, "run_no", "run", F.explode(F.flatten(singles)).alias("_w"))
    return rows.select(key, "run_no", F.col("_w.at").alias("at"), F.col("run").substr(F.col("_w.at"), F.col("_w.n")).alias("word"))
