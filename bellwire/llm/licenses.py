"""License scans by diagonal voting between word grams of texts and of license templates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwire.llm import spans
from bellwire.session import small_side

K = 2
# Diagonals this close belong to one match: a word was added or left out.
SLIP = 2
# Share of a template's words that a span must hold. Short phrases must stand whole.
COVERAGE = 0.8

# Phrases and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Public license wording that the method knows besides.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license", "mpl"),
    ("this work is licensed under a creative commons attribution", "cc-by"),
    ("cc by nc", "cc-by-nc"),
    ("all rights reserved", "proprietary"),
]

SPAN = "struct<start: long, stop: long, label: string, base: boolean, score: double>"


def words_of(text: str) -> list[bytes]:
    data, at = spans.text_bytes(pa.array([text]))
    data = spans.LOWER[data]
    starts, ends, _ = spans.runs(data, at, spans.ALNUM)
    return [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]


def template_grams(spark: SparkSession, phrases: Iterable, notices: Iterable) -> DataFrame:
    """Every k-gram of every template: its hash, words, template and place."""
    rows = []
    for base, texts in ((True, phrases), (False, notices)):
        for text, label in texts:
            words = words_of(text)
            if len(words) < K:
                raise ValueError(f"a template needs {K} words: {text!r}")
            joined = pa.array([b" ".join(words).decode()])
            data, at = spans.text_bytes(joined)
            starts, ends, row = spans.runs(data, at, spans.ALNUM)
            hashes, first = spans.gram_hashes(spans.span_hashes(data, starts, ends), row, K)
            for h, i in zip(spans.bit_equal(hashes).tolist(), first.tolist()):
                gram = b" ".join(words[i : i + K]).decode()
                rows.append((h, gram, f"{base}:{' '.join(w.decode() for w in words)}", label, base, len(words), i))
    schema = "hash long, t_gram string, template string, label string, base boolean, size int, t_pos int"
    return spark.createDataFrame(rows, schema)


def gram_texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> pa.Array:
    """The words of each k-gram with one space between them."""
    lengths = ends - starts
    to = np.concatenate(([0], np.cumsum(lengths + 1)))
    words = np.full(int(to[-1]), 32, np.uint8)
    place = np.arange(int(lengths.sum()))
    words[place + np.repeat(np.arange(len(starts)), lengths)] = data[
        place + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
    ]
    sizes = to[first + K] - 1 - to[first]
    ends_at = np.concatenate(([0], np.cumsum(sizes)))
    copied = words[np.repeat(to[first] - ends_at[:-1], sizes) + np.arange(int(ends_at[-1]))]
    return pa.LargeStringArray.from_buffers(
        len(first), pa.py_buffer(ends_at.astype(np.int64)), pa.py_buffer(copied)
    ).cast(pa.string())


def text_grams(docs: DataFrame) -> DataFrame:
    """All rolling k-grams of all texts, and one row with ``pos`` -1 for each text.

    The gram's words travel along, so that equal hashes can be told from equal words.
    """

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in spans.chunks(batches, "text", 1 << 20):
            data, at = spans.text_bytes(part["text"])
            data = spans.LOWER[data]
            starts, ends, rows = spans.runs(data, at, spans.ALNUM)
            hashes, first = spans.gram_hashes(spans.span_hashes(data, starts, ends), rows, K)
            n = part.num_rows
            n_words = np.bincount(rows, minlength=n)
            begin = np.concatenate(([0], np.cumsum(n_words)))[:-1]
            gram = gram_texts(data, starts, ends, first)
            row = rows[first]
            yield pa.record_batch(
                [
                    part["doc_id"].take(pa.array(row)),
                    part["copy"].take(pa.array(row)),
                    pa.nulls(len(row), pa.int64()),
                    pa.array(first - begin[row], pa.int64()),
                    pa.array(spans.bit_equal(hashes)),
                    gram,
                ],
                names=["doc_id", "copy", "n_words", "pos", "hash", "gram"],
            )
            yield pa.record_batch(
                [
                    part["doc_id"],
                    part["copy"],
                    pa.array(n_words, pa.int64()),
                    pa.array(np.full(n, -1)),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.string()),
                ],
                names=["doc_id", "copy", "n_words", "pos", "hash", "gram"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("copy"), "text"
    ).mapInArrow(grams, "doc_id long, copy long, n_words long, pos long, hash long, gram string")


def merged_spans(diagonals: list[dict]) -> list[dict]:
    """Verified spans of one text from its diagonals: ``template, label, base, size, diagonal, places``."""
    found = []
    by_template: dict[str, list[dict]] = {}
    for d in diagonals:
        by_template.setdefault(d["template"], []).append(d)
    for group in by_template.values():
        size, base, label = group[0]["size"], group[0]["base"], group[0]["label"]
        group.sort(key=lambda d: d["diagonal"])
        run: list[dict] = []
        for d in [*group, None]:
            near = d and run and not base and size >= 5 and d["diagonal"] - run[-1]["diagonal"] <= SLIP
            if run and not near:
                # Each gram on a diagonal stands for k words of the template and of the text.
                here = {p + j for x in run for p in x["places"] for j in range(K)}
                at = [x["diagonal"] + p for x in run for p in x["places"]]
                start, stop = min(at), max(at) + K
                share = len(here) / size
                whole = len(here) == size and stop - start == size
                if whole if base or size < 5 else share >= COVERAGE and stop - start <= size + 2 * SLIP:
                    found.append({"start": start, "stop": stop, "label": label, "base": base, "score": share})
                run = []
            if d:
                run.append(d)
    return sorted(found, key=lambda s: (s["start"], s["stop"], s["label"], s["base"]))


def scan(docs: DataFrame, phrases: Iterable = PHRASES, notices: Iterable = NOTICES) -> DataFrame:
    """``doc_id, n_words, spans`` per row of ``docs``: license wording with its place and label.

    All rolling word pairs of all texts are joined with the pairs of the templates. Matches are
    counted per text, template and diagonal (place in the text minus place in the template),
    neighbouring diagonals are merged, and a span is kept if enough of the template's words are in
    it. ``phrases`` must stand whole and consecutively. The templates are arguments; they
    are broadcast only if measured to be small. A null text is empty; a row without any span is
    listed with an empty array; repeated rows are listed as often as they occur.
    """
    templates = small_side(template_grams(docs.sparkSession, phrases, notices))
    grams = text_grams(docs)
    hits = grams.join(
        templates, (grams["hash"] == templates["hash"]) & (F.col("gram") == F.col("t_gram")), "left"
    ).where("t_pos IS NOT NULL OR pos = -1")
    votes = hits.groupBy(
        "doc_id", "copy", "template", "label", "base", "size", (F.col("pos") - F.col("t_pos")).alias("diagonal")
    ).agg(
        F.max("n_words").alias("n_words"),
        F.sum(F.when(F.col("pos") == -1, 1).otherwise(0)).alias("copies"),
        F.collect_set("t_pos").alias("places"),
    )
    one = F.struct("template", "label", "base", "size", "diagonal", "places")
    texts = votes.groupBy("doc_id", "copy").agg(
        F.max("n_words").alias("n_words"),
        F.sum("copies").alias("copies"),
        F.collect_list(F.when(F.col("template").isNotNull(), one)).alias("diagonals"),
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct(
                [("start", pa.int64()), ("stop", pa.int64()), ("label", pa.string()), ("base", pa.bool_()), ("score", pa.float64())]
            )
        )
        for batch in batches:
            rows = [merged_spans(d or []) for d in batch["diagonals"].to_pylist()]
            yield pa.record_batch(
                [batch["doc_id"], batch["n_words"], batch["copies"], pa.array(rows, kind)],
                names=["doc_id", "n_words", "copies", "spans"],
            )

    checked = texts.mapInArrow(verify, f"doc_id long, n_words long, copies long, spans array<{SPAN}>")
    return checked.select("doc_id", "n_words", "spans", F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")).drop("_copy")


def digest(found: DataFrame) -> DataFrame:
    """The scan as one row of plain columns per document."""
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])

    def joined(spans_):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans_, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )
