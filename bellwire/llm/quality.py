"""Quality rules whose cut-offs reject few good documents, by exact binomial bounds on labelled rows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwire.llm import spans
from bellwire.session import settled, small_side, stored

# Good documents that all rules together may reject in each stratum, and the chance to be wrong.
MAX_LOSS = 0.02
ERROR = 0.05

# Fixed values of the base rules.
LEAST_WORDS = 50
SYMBOLS = b"#*$%&|<>"

# Rules: a measure of which large values are bad, and cut-offs from the mildest to the strictest.
RULES: dict[str, tuple[float, ...]] = {
    "symbol_share": (1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1, 0.05),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "repeat_share": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "word_length": (20.0, 16.0, 14.0, 12.0, 10.0, 9.0, 8.0),
    "upper_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_upper"]


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column ``_m`` of counts per text (a null text is empty)."""
    if "_m" in docs.columns:
        raise ValueError("documents must not have a column _m")
    names = COUNTS + EXTRA
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    upper = np.zeros(256, bool)
    upper[65:91] = True

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in spans.chunks(batches, "text"):
            data, at = spans.text_bytes(part["text"])
            n = part.num_rows
            row_of = np.repeat(np.arange(n), np.diff(at))
            starts, ends, rows = spans.runs(data, at, spans.SPACED)
            points = row_of[spans.SPACED[data] & ((data < 0x80) | (data >= 0xC0))]
            hashes, first = spans.gram_hashes(spans.span_hashes(data, starts, ends), rows, 3)
            grams = spans.mix(hashes + rows[first].astype(np.uint64))
            _, inverse, times = np.unique(grams, return_inverse=True, return_counts=True)
            again = first[times[inverse] > 1] if len(grams) else first
            covered = np.zeros(len(starts) + 3, bool)
            for j in range(3):
                covered[again + j] = True
            a, b, line_row = spans.line_runs(data, at)
            filled = np.concatenate(([0], np.cumsum(spans.SPACED[data])))
            with_word = filled[b] > filled[a]
            a, b, line_row = a[with_word], b[with_word], line_row[with_word]
            lines = spans.mix(spans.span_hashes(data, a, b) + line_row.astype(np.uint64))
            _, firsts = np.unique(lines, return_index=True)
            n_lines = np.bincount(line_row, minlength=n)
            values = [
                np.bincount(rows, minlength=n),
                np.bincount(points, minlength=n),
                np.bincount(row_of[symbol[data]], minlength=n),
                n_lines - np.bincount(line_row[firsts], minlength=n),
                np.bincount(rows[covered[: len(rows)]], minlength=n),
                n_lines,
                np.bincount(row_of[upper[data]], minlength=n),
            ]
            counts = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in values], names)
            yield pa.record_batch([*part.columns, counts], names=[*part.schema.names, "_m"])

    extra = T.StructType([T.StructField(x, T.LongType()) for x in names])
    return docs.mapInArrow(counted, T.StructType([*docs.schema.fields, T.StructField("_m", extra)]))


def measures() -> dict[str, Column]:
    """The measures of ``RULES`` from ``_m``."""
    m = {x: F.col(f"_m.{x}").cast("double") for x in COUNTS + EXTRA}

    def share(a: str, b: str) -> Column:
        return F.when(m[b] > 0, m[a] / m[b]).otherwise(0.0)

    return {
        "symbol_share": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "word_length": share("word_chars", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
    }


def base_failed() -> Column:
    """Too few words, or more than half of the words in repeated windows of three."""
    words, repeated = F.col("_m.n_words"), F.col("_m.n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeated > 50 * words)


def binomial_tail(x: int, n: int, p: float) -> float:
    """P(X <= x) of a binomial, summed in logarithms."""
    if p <= 0.0:
        return 1.0
    if p >= 1.0:
        return 1.0 if x >= n else 0.0
    whole = math.lgamma(n + 1)
    terms = [
        whole - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
        for k in range(x + 1)
    ]
    most = max(terms)
    return min(1.0, math.exp(most) * math.fsum(math.exp(t - most) for t in terms))


def holds(lost: int, n: int, limit: float, error: float) -> bool:
    """Whether the exact upper bound (level ``error``) of the loss rate is at most ``limit``."""
    if lost >= limit * n:
        return False
    return binomial_tail(lost, n, limit) <= error


def calibrate(measured: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """One row per stratum with the strictest cut-off of each rule that is proven safe.

    The good labelled documents are the holdout. Cut-offs of a rule are tested from the mildest on
    and the walk ends at the first that isn't proven, so only rules and strata count as tests:
    the error is divided by their number (Bonferroni), the loss by the number of rules. A rule
    with no proven cut-off rejects nothing (null). Only counts per stratum leave the table.
    """
    rated = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_good"))
    rated = rated.groupBy("_id").agg(F.max("_good").alias("_good"))
    good = measured.where(~base_failed()).join(rated, F.col("doc_id") == F.col("_id")).where("_good = 1")
    values = measures()
    counts = settled(
        good.groupBy(F.col(stratum).cast("string").alias("_stratum")).agg(
            F.count("*").alias("n"),
            F.array(
                *[
                    F.array(*[F.count_if(values[rule] > cut) for cut in cuts])
                    for rule, cuts in RULES.items()
                ]
            ).alias("lost"),
        )
    )
    strata = counts.count()
    error = ERROR / max(1, strata * len(RULES))
    limit = MAX_LOSS / len(RULES)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for n, lost in zip(batch["n"].to_pylist(), batch["lost"].to_pylist()):
                row = []
                for cuts, x in zip(RULES.values(), lost):
                    best = None
                    for cut, k in zip(cuts, x):
                        if not holds(k, n, limit, error):
                            break
                        best = cut
                    row.append(best)
                rows.append(row)
            columns = [pa.array([r[i] for r in rows], pa.float64()) for i in range(len(RULES))]
            yield pa.record_batch([batch["_stratum"], *columns], names=["_stratum", *[f"_cut_{r}" for r in RULES]])

    schema = ", ".join(["_stratum string", *[f"_cut_{r} double" for r in RULES]])
    return counts.mapInArrow(choose, schema)


def verdicts(measured: DataFrame, cuts: DataFrame, stratum: str = "lang") -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``.

    A document is kept unless a base rule fails or a measure passes its stratum's cut-off. Without
    good labelled rows for a stratum (a null one is a stratum too) only the base rules decide.
    """
    judged = measured.join(
        small_side(cuts), F.col(stratum).cast("string").eqNullSafe(F.col("_stratum")), "left"
    )
    over = F.lit(False)
    for rule, value in measures().items():
        over = over | F.coalesce(value > F.col(f"_cut_{rule}"), F.lit(False))
    return (
        judged.withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~over)
        .drop("_stratum", *[f"_cut_{r}" for r in RULES])
    )


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict of every document, repeated rows each. Texts are read once; counts are stored."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    counted = stored(measure(narrow).drop("text"), "quality")
    judged = verdicts(counted, calibrate(counted, labels))
    return judged.select("doc_id", *[F.col(f"_m.{c}").alias(c) for c in COUNTS], "base_failed", "kept")


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns, whatever else these are.

    ``docs`` needs ``doc_id``, ``text`` and ``lang``.
    """
    counted = measure(docs.select("doc_id", "lang", "text")).drop("text")
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text", "lang")
    judged = verdicts(measure(inner), calibrate(counted, labels))
    return judged.where("kept").select("_row.*")
