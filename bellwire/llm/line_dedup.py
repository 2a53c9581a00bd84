"""Line dedup: an exact set-similarity join of lines; later lines that match an earlier one are removed."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwire.llm import spans
from bellwire.llm.token_order import TokenOrder, needed, ordered_sets, parities, token_order
from bellwire.session import small_side, stored

# Lines match when 100 * intersection >= PERCENT * union of their distinct words.
PERCENT = 80
# Numbers of 64 cells in a line's signature: the parity of how many of its words fall in each cell.
SIGN_WORDS = 2
SIGN = [f"s{w}" for w in range(SIGN_WORDS)]

# A line's place: its number, then 32 bits that tell texts of one id apart.
LINE = "struct<doc_id: long, line: long>"
TEXT_BITS = (1 << 32) - 1


def text_checks(texts: pa.Array) -> np.ndarray:
    """CRC-32 of each text, as Spark's ``crc32`` has it; 0 for a null one."""
    data, at = spans.text_bytes(texts)
    raw = memoryview(data.tobytes())
    return np.array([zlib.crc32(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], np.int64)


def text_check() -> Column:
    return F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0).cast("long"))


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, where each text starts, then hash and start of each word."""
    data, at = spans.text_bytes(texts)
    data = spans.lowered(data)
    starts, ends = spans.run_bounds(spans.spaced(data), at)
    return data, at, spans.span_hashes(data, starts, ends), starts


def line_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all lines: hash and line of each; then row and number (from 0) of each line."""
    data, at, hashes, starts = words_of(texts)
    a, _, rows = spans.line_runs(data, at)
    # Both ascend: a line's words are those that start before the next line.
    lines = np.repeat(np.arange(len(a)), np.diff(np.searchsorted(starts, a), append=len(starts)))
    # Lines of empty texts start where the next text starts; the words belong to the last of these.
    first = np.searchsorted(rows, np.arange(len(at) - 1))
    numbers = np.arange(len(rows)) - first[rows] if len(rows) else rows
    return hashes, lines, rows, numbers


def line_sets(texts: pa.Array, order: TokenOrder | None):
    """Distinct words of each line, in the global order: tokens, their line; row and number of each line."""
    hashes, lines, rows, numbers = line_tokens(texts)
    return *ordered_sets(hashes, lines, order), rows, numbers


def prefix_rows(docs: DataFrame, order: TokenOrder) -> DataFrame:
    """``doc_id, line, n, set_key, prefix, s0, s1`` of each line with a word; ``line`` is its place, ``s0`` and ``s1`` its signature."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in spans.chunks(batches, "text"):
            tokens, lines, rows, numbers = line_sets(part["text"], order)
            sizes = np.bincount(lines, minlength=len(rows))
            at = np.concatenate(([0], np.cumsum(sizes)))
            keys = np.zeros(len(rows), np.uint64)
            np.add.at(keys, lines, spans.mix(tokens))
            able = np.flatnonzero(sizes)
            lengths = np.zeros(len(rows), np.int64)
            lengths[able] = sizes[able] + (-PERCENT * sizes[able] // 100) + 1
            place = np.arange(len(tokens)) - at[lines]
            prefix = spans.bit_equal(tokens[place < lengths[lines]])
            bounds = np.concatenate(([0], np.cumsum(lengths[able]))).astype(np.int32)
            sign = parities(tokens, lines, len(rows), SIGN_WORDS).flatten().to_numpy().reshape(-1, SIGN_WORDS)[able]
            yield pa.record_batch(
                [
                    part["doc_id"].take(pa.array(rows[able])),
                    pa.array(numbers[able] << 32 | text_checks(part["text"])[rows[able]], pa.int64()),
                    pa.array(sizes[able], pa.int32()),
                    pa.array(spans.bit_equal(keys[able])),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(prefix)),
                    *[pa.array(sign[:, w]) for w in range(SIGN_WORDS)],
                ],
                names=["doc_id", "line", "n", "set_key", "prefix", *SIGN],
            )

    kinds = "doc_id long, line long, n int, set_key long, prefix array<long>, s0 long, s1 long"
    return docs.select("doc_id", "text").mapInArrow(make, kinds)


def sets_of(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``ref, words``: the distinct words of the lines asked for (column ``ref``), stored."""
    check = F.col("ref.line").bitwiseAND(F.lit(TEXT_BITS))
    asked = lines.groupBy(F.col("ref.doc_id").alias("_id"), check.alias("_check")).agg(F.collect_set("ref.line").alias("_lines"))
    mine = (F.col("doc_id") == F.col("_id")) & (text_check() == F.col("_check"))
    wanted = docs.join(small_side(asked), mine).select("doc_id", "_lines", "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in spans.chunks(batches, "text"):
            tokens, lines, rows, numbers = line_sets(part["text"], None)
            at = np.concatenate(([0], np.cumsum(np.bincount(lines, minlength=len(rows)))))
            first = np.searchsorted(rows, np.arange(part.num_rows))
            asked_ = part["_lines"].to_pylist()
            places = [k for ks in asked_ for k in ks]
            chosen = [first[i] + (k >> 32) for i, ks in enumerate(asked_) for k in ks]
            signed = spans.bit_equal(tokens)
            words = pa.array([signed[at[k] : at[k + 1]] for k in chosen], pa.list_(pa.int64()))
            chosen = np.array(chosen, np.int64)
            ref = pa.StructArray.from_arrays(
                [part["doc_id"].take(pa.array(rows[chosen])), pa.array(places, pa.int64())], ["doc_id", "line"]
            )
            yield pa.record_batch([ref, words], names=["ref", "words"])

    return stored(wanted.mapInArrow(make, f"ref {LINE}, words array<long>"), "line-sets")


def could_match(n: Column, m: Column, i: Column, j: Column) -> Column:
    """Length and positional filter of sizes ``n`` and ``m`` with a common token at places ``i`` and ``j``.

    At most the tokens before both places, this one, and those after it on the shorter side are common.
    """
    most = F.least(i, j) + 1 + F.least(n - i, m - j) - 1
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & ((100 + PERCENT) * most >= PERCENT * (n + m))


def overlapping() -> Column:
    """Whether the signatures of two lines (columns of ``_x`` and ``_y``) let their overlap be large enough.

    A cell of unequal parity holds a word of one side alone.
    """
    unequal = sum((F.bit_count(F.col(f"{s}_x").bitwiseXOR(F.col(f"{s}_y"))) for s in SIGN), F.lit(0))
    return F.floor((F.col("n_x") + F.col("n_y") - unequal) / 2) >= needed("n_x", "n_y", PERCENT)


def earlier() -> Column:
    """Whether the line of columns ``_x`` stands before that of ``_y``."""
    first = F.col("doc_id_x") < F.col("doc_id_y")
    return first | ((F.col("doc_id_x") == F.col("doc_id_y")) & (F.col("line_x") < F.col("line_y")))


def placed(rows: DataFrame, at: str) -> DataFrame:
    """``rows`` with the size ``n`` and place ``i`` that the number in ``at`` holds."""
    return rows.withColumns(
        {at.replace("at", "n"): F.shiftright(at, 32), at.replace("at", "i"): F.col(at).bitwiseAND(F.lit(0x7FFFFFFF))}
    )


def largest_partner(n: Column, i: Column) -> Column:
    """The most words a line may have to match one of ``n`` words with place ``i`` as the first in common.

    All common words stand from there on, so ``(100 + PERCENT) * (n - i) >= PERCENT * (n + m)``; see ``first_common``.
    """
    return F.floor(((100 + PERCENT) * (n - i) - PERCENT * n) / PERCENT)


def meeting(rows: DataFrame, side: str) -> DataFrame:
    """One side of a join of ``rows`` with themselves: most pairs of a token fall by two numbers that each row holds.

    As ``y``, rows of a negated place match nothing. No column is nullable, so that no filter comes between a side and
    the exchange that both read.
    """
    place = F.greatest(F.col("at"), -1 - F.col("at"))
    n, i = F.shiftright(place, 32), place.bitwiseAND(F.lit(0x7FFFFFFF))
    most = largest_partner(n, i)
    numbers = {"n": n, "most": F.when(F.col("at") >= 0, most) if side == "y" else most}
    columns = {c: F.col(c) for c in ("doc_id", "line", *SIGN)} | numbers
    return rows.select(
        F.col("token").alias(f"token_{side}"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(f"{name}_{side}") for name, c in columns.items()],
    )


def refs(side: str) -> Column:
    return F.struct(F.col(f"doc_id_{side}").alias("doc_id"), F.col(f"line_{side}").alias("line"))


def matched(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Distinct ``later`` lines of the pairs (``earlier``, ``later``) whose Jaccard similarity is high enough."""
    lines = pairs.select(F.col("earlier").alias("ref")).union(pairs.select(F.col("later").alias("ref"))).distinct()
    sets = sets_of(docs, lines)
    x = sets.select(F.col("ref").alias("earlier"), F.col("words").alias("x"))
    y = sets.select(F.col("ref").alias("later"), F.col("words").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    close = 100 * both >= PERCENT * (F.size("x") + F.size("y") - both)
    return pairs.join(x, "earlier").join(y, "later").where(close).select("later").distinct()


def duplicate_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, line, check`` of every line that an earlier line matches; earlier by id, then by number.

    ``check`` is the text's CRC-32: of rows that repeat an id, only those with this text lose the line.

    1. Lines with equal sets form a class; all but its first line are duplicates of it.
    2. The first lines meet on the tokens of their prefixes, in the global order of rarity.
    3. A token's earliest line meets all others; what matches it is settled.
    4. Lines that are left meet all earlier lines of their tokens, where a token can be the first that both
       have in common. Length, position and signatures rule pairs out; the rest is verified.
    """
    order = token_order(docs, lambda part: words_of(part["text"])[2])
    lines = stored(prefix_rows(docs, order).withColumn("row", F.monotonically_increasing_id()), "lines")
    # Only the places of lines move to find equal sets; their prefixes stay where they are.
    equal = lines.groupBy(F.col("set_key").alias("_key"), F.col("n").alias("_n"))
    copied = equal.agg(F.count("*").alias("_times"), F.min("doc_id").alias("_doc")).where("_times > 1").drop("_times")
    same = (F.col("set_key") == F.col("_key")) & (F.col("n") == F.col("_n"))
    firsts = lines.join(small_side(copied), same & (F.col("doc_id") == F.col("_doc"))).groupBy("_key", "_n")
    copies = small_side(firsts.agg(F.min(F.struct("doc_id", "line", "row")).alias("_first")))
    tagged = lines.join(copies, same, "left")
    # Rows that repeat an id and a text have lines of one place.
    other = (F.col("doc_id") != F.col("_first.doc_id")) | (F.col("line") != F.col("_first.line"))
    copy = F.col("_first").isNotNull() & other
    # Flat rows: size and place in one number, signatures of fixed size however long a line is.
    held = ("doc_id", "line", "at", *SIGN)
    at = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("i").cast("long")).alias("at")
    tokens = (
        tagged.where("coalesce(_first.row = row, true)")
        .select("doc_id", "line", "n", *SIGN, F.posexplode("prefix").alias("i", "token"))
        .select("token", "doc_id", "line", at, *SIGN)
    )
    # A token's lines pass by in order behind its first one: one sort, nothing held but that line.
    ordered = Window.partitionBy("token").orderBy("doc_id", "line")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = tokens.select(
        *[F.first(c).over(so_far).alias(f"{c}_x") for c in held], *[F.col(c).alias(f"{c}_y") for c in held]
    )
    first = (
        placed(placed(both, "at_x"), "at_y")
        .where(F.when(earlier(), could_match(F.col("n_y"), F.col("n_x"), F.col("i_y"), F.col("i_x")) & overlapping()))
        .select(refs("x").alias("earlier"), refs("y").alias("later"))
        .distinct()
    )
    settled_ = stored(matched(docs, stored(first, "line-pairs")), "matched")
    # Only a token that can be the first common one of a pair makes it. Settled lines have their places negated and are
    # told apart in a condition of both sides, so that both read the same exchange.
    gone_ = small_side(settled_.select("later.doc_id", "later.line", F.lit(True).alias("_settled")))
    place = F.when(F.col("_settled"), -1 - F.col("at")).otherwise(F.col("at"))
    full = tokens.join(gone_, ["doc_id", "line"], "left").withColumn("at", place).select("token", *held).repartition("token")
    x, y = meeting(full, "x"), meeting(full, "y")
    second = (
        x.join(
            y,
            (F.col("token_x") == F.col("token_y"))
            & (F.col("n_y") <= F.col("most_x"))
            & (F.col("n_x") <= F.col("most_y"))
            & earlier()
            & overlapping(),
        )
        .select(refs("x").alias("earlier"), refs("y").alias("later"))
        .distinct()
    )
    more = matched(docs, stored(second, "line-pairs"))
    near = small_side(settled_.union(more).select("later.doc_id", "later.line").distinct())
    late = lines.join(near, ["doc_id", "line"], "left_semi").select(F.col("set_key").alias("_k"), F.col("n").alias("_m"))
    late = small_side(late.distinct().withColumn("_near", F.lit(True)))
    judged = tagged.join(late, (F.col("set_key") == F.col("_k")) & (F.col("n") == F.col("_m")), "left")
    return judged.where(copy | F.col("_near").isNotNull()).select(
        "doc_id",
        F.shiftright("line", 32).cast("int").alias("line"),
        F.col("line").bitwiseAND(F.lit(TEXT_BITS)).alias("check"),
    )


def remove_lines(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the lines ``gone``, and the struct ``_n`` of ``lines`` and ``removed``."""
    by_doc = gone.groupBy(F.col("doc_id").alias("_id"), F.col("check").alias("_check")).agg(F.collect_set("line").alias("_gone"))
    mine = (F.col("doc_id") == F.col("_id")) & (text_check() == F.col("_check"))
    joined = docs.join(small_side(by_doc), mine, "left").drop("_id", "_check")
    kind = pa.struct([("lines", pa.int64()), ("removed", pa.int64())])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in spans.chunks(batches, "text"):
            lines = pc.add(pc.fill_null(pc.count_substring(part["text"], "\n"), 0).cast(pa.int64()), 1)
            cut = part["_gone"].is_valid()
            texts, removed = [], []
            # Texts that lose no line pass through.
            for text, lost in zip(part["text"].filter(cut).to_pylist(), part["_gone"].filter(cut).to_pylist()):
                drop = set(lost)
                kept = (x for i, x in enumerate((text or "").split("\n")) if i not in drop)
                texts.append("\n".join(kept) if drop else text)
                removed.append(len(drop))
            n_removed = np.zeros(part.num_rows, np.int64)
            n_removed[cut.to_numpy(zero_copy_only=False)] = removed
            names = [c for c in part.schema.names if c != "_gone"]
            text = pc.replace_with_mask(part["text"], cut, pa.array(texts, part["text"].type)) if texts else part["text"]
            counts = pa.StructArray.from_arrays([lines, pa.array(n_removed)], fields=list(kind))
            yield pa.record_batch([*(text if c == "text" else part[c] for c in names), counts], names=[*names, "_n"])

    extra = T.StructType([T.StructField("lines", T.LongType()), T.StructField("removed", T.LongType())])
    return joined.mapInArrow(rewrite, T.StructType([*docs.schema.fields, T.StructField("_n", extra)]))


def narrowed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")


def dedup_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` of every document.

    Lines are what stands between line feeds; their words stand between white space, A-Z
    lower-cased; a line is the set of its words, and one without words stays. Whether an earlier line is
    itself removed doesn't matter. A null text stays null and counts one empty line; an empty table gives
    no rows. Rows that repeat an id and a text lose the same lines; of different texts with one id, lines with smaller
    numbers are earlier. Rows without an id stay.
    """
    rewritten = remove_lines(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), duplicate_lines(narrowed(docs)))
    return rewritten.select("doc_id", F.col("_n.lines").alias("n_lines"), F.col("_n.removed").alias("n_removed"), "text")


def dedup_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with the remaining text and its length in ``n_chars``; every row stays, maybe with an empty text."""
    inner = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    cut = remove_lines(inner, duplicate_lines(narrowed(docs)))
    changed = F.col("_n.removed") > 0
    values = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        old = F.col("_row.n_chars")
        values["n_chars"] = F.when(changed, F.char_length("text")).otherwise(old).cast(docs.schema["n_chars"].dataType)
    return cut.select(*[values.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
