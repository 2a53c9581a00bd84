"""Mixing sources to target weights by capped water-filling; only DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bellwire.operators.scans import global_row_number
from bellwire.session import small_side, stored

# Weights by rank of the source, share of all words, most repetitions.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
EPOCHS = 2.0

SEED = 11
# Cells per level of the search for a source's last document, and bits of each level.
BITS = 12
LEVELS = 3
# Equal rows that are numbered together.
RUN = 10_000


def n_words(text: Column) -> Column:
    """Words between white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(copy: Column, seed: int = SEED) -> Column:
    """A seeded number of 36 bits per document and copy, the same in every run."""
    hashed = F.xxhash64(F.lit(seed), F.col("_id"), F.col("_source"), F.col("_hash"), copy)
    return F.shiftrightunsigned(hashed, 64 - BITS * LEVELS)


def water_level(sources: DataFrame, total: float) -> float:
    """The level at which ``min(level * weight, cap)`` of all sources adds up to ``total``.

    Sources above their cap are clamped and what they leave is shared again by weight, until
    none is above. Each round is one aggregate of two sums. If the caps do not reach, all are clamped.
    """
    level = 0.0
    while True:
        open_ = F.col("_cap") > F.lit(level) * F.col("_weight")
        row = sources.agg(
            F.sum(F.when(~open_, F.col("_cap")).otherwise(0.0)).alias("clamped"),
            F.sum(F.when(open_, F.col("_weight")).otherwise(0.0)).alias("weight"),
        ).first()
        if not row["weight"]:
            return float("inf")
        new = (total - row["clamped"]) / row["weight"]
        if new <= level * (1 + 1e-15):
            return level
        level = new


def source_targets(sizes: DataFrame, share: float, epochs: float, weights: tuple) -> DataFrame:
    """``_source, source_size, target``, one row per source, null last among the ranks."""
    totals = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    ranked = global_row_number(totals, [F.col("_source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    sources = stored(
        ranked.select(
            "_source", "source_size", weight.alias("_weight"), (F.col("source_size") * F.lit(epochs)).alias("_cap")
        ),
        "mix-sources",
    )
    total = sources.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    level = water_level(sources, share * total)
    return sources.withColumn("target", F.least(F.col("_cap"), F.lit(level) * F.col("_weight")))


def cell(level: int) -> Column:
    """The part of ``_draw`` that names a document's cell on a level."""
    return F.shiftright(F.col("_draw"), BITS * (LEVELS - 1 - level))


def cut_points(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``_whole`` repetitions and the last document that gets one more.

    Documents of a source are ordered by their draw; those up to the last one add up to what is
    missing to the target. The search narrows on cells of the draw: sums per cell (one partial
    aggregate), then the cell in which the sum is reached, then its cells. A window holds at most
    4096 cells of a source, and at last only the documents of one cell in 2^36.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.withColumn("_whole", whole.cast("long")).withColumn(
        "_need", F.col("target") - F.col("_whole") * F.col("source_size")
    )
    found = state.select("_source", "_need", F.lit(-1).cast("long").alias("_cell"))
    for level in range(LEVELS):
        here = found.select(F.col("_source").alias("_s"), "_need", "_cell")
        inside = F.lit(True) if level == 0 else cell(level - 1) == F.col("_cell")
        sums = (
            sizes.join(small_side(here), F.col("_source").eqNullSafe(F.col("_s")) & inside)
            .groupBy("_source", "_need", cell(level).alias("_at"))
            .agg(F.sum("size").alias("_sum"))
        )
        running = F.sum("_sum").over(
            Window.partitionBy("_source").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
        )
        before = F.col("_run") - F.col("_sum")
        found = (
            sums.withColumn("_run", running)
            .where((before <= F.col("_need")) & (F.col("_need") < F.col("_run")))
            .select("_source", (F.col("_need") - before).alias("_need"), F.col("_at").alias("_cell"))
        )
    last = found.select(F.col("_source").alias("_s"), F.col("_need").alias("_rest"), "_cell")
    ordered = Window.partitionBy("_source").orderBy(*[F.col(f"_key.{c}").asc_nulls_first() for c in KEY])
    upto = F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    ends = (
        sizes.join(small_side(last), F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_draw") == F.col("_cell")))
        .withColumn("_key", key())
        .withColumn("_upto", upto)
        # The document over the border goes in if that brings the sum nearer to the target.
        .where((F.col("_upto") - F.col("size") / 2 <= F.col("_rest")) & (F.col("size") > 0))
        .groupBy("_source")
        .agg(F.max("_key").alias("_end"))
    )
    borders = last.join(ends.select(F.col("_source").alias("_t"), "_end"), F.col("_s").eqNullSafe(F.col("_t")), "left")
    return state.join(borders.drop("_t"), F.col("_source").eqNullSafe(F.col("_s")), "left").select(
        "_source", "source_size", "target", "_whole", "_cell", "_end"
    )


# The order of a source's documents and copies.
KEY = ("_draw", "_some", "_id", "_hash", "_copy")


def key() -> Column:
    some = F.col("_id").isNotNull().alias("_some")
    return F.struct("_draw", some, F.coalesce("_id", F.lit(0)).alias("_id"), "_hash", "_copy")


def with_repetitions(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` with their source's ``_whole`` repetitions and whether they get one more (``_more``)."""
    cuts = cuts.withColumnRenamed("_source", "_s")
    joined = rows.join(small_side(cuts), F.col("_source").eqNullSafe(F.col("_s")), "left")
    more = F.when(F.col("_cell").isNull(), False).otherwise(
        (F.col("_draw") < F.col("_cell")) | F.coalesce(key() <= F.col("_end"), F.lit(False))
    )
    return joined.withColumn("_more", more.cast("long")).drop("_s")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with what a draw depends on: id, source and a hash of the text."""
    return docs.withColumns(
        {
            "_id": F.col("doc_id").cast("long"),
            "_source": F.col("source").cast("string"),
            "_hash": F.xxhash64(F.lit(SEED), F.coalesce("text", F.lit(""))),
        }
    )


def drawn(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_draw", draw(F.col("_copy")))


def copies(groups: DataFrame) -> DataFrame:
    """A row per copy (``_copy`` from 1) of rows that are repeated ``_n`` times, in runs that go to several tasks."""
    runs = groups.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / RUN))))
    dealt = runs.repartition("_id", "_source", "_hash", "_run")
    last = F.least(F.col("_n"), (F.col("_run") + 1) * RUN)
    return dealt.withColumn("_copy", F.explode(F.sequence(F.col("_run") * RUN + 1, last))).drop("_run")


def plan_mix(docs: DataFrame, share: float, epochs: float, weights: tuple) -> tuple[DataFrame, DataFrame]:
    """The narrow table of all documents with a draw each, stored, and the cuts per source.

    Rows that are equal in id, source and text are added up and then numbered, so that each has a draw of its own and
    no window or task holds a group of them.
    """
    narrow = keyed(docs).select("_id", "_source", "_hash", n_words(F.col("text")).alias("size"))
    groups = stored(narrow.groupBy("_id", "_source", "_hash", "size").agg(F.count("*").alias("_n")), "mix-groups")
    once = groups.where("_n = 1").withColumn("_copy", F.lit(1).cast("long"))
    sizes = stored(drawn(once.unionByName(copies(groups.where("_n > 1")))), "mix-sizes")
    return sizes, stored(cut_points(sizes, source_targets(sizes, share, epochs, weights)), "mix-cuts")


def mix_report(
    docs: DataFrame, share: float = SHARE, epochs: float = EPOCHS, weights: tuple = WEIGHTS
) -> DataFrame:
    """What the mix takes of each document: ``doc_id, size, source_size, target, taken``.

    A null source is a source of its own and ranks last. Documents without words take
    nothing. Rows that repeat an id have draws of their own, be their texts different or equal. The
    number of sources is not bounded: they are ranked by a distributed sort and joined without
    a broadcast beyond the measured limit.
    """
    sizes, cuts = plan_mix(docs, share, epochs, weights)
    times = F.col("_whole") + F.col("_more")
    return with_repetitions(sizes, cuts).select(
        F.col("_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def mix_documents(
    docs: DataFrame, share: float = SHARE, epochs: float = EPOCHS, weights: tuple = WEIGHTS
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Of rows that are equal in id, source and text, the repetitions that only some of them get are taken of one of them.
    """
    sizes, cuts = plan_mix(docs, share, epochs, weights)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    inner = drawn(keyed(docs.select(row, "doc_id", "source", "text")).withColumn("_copy", F.lit(1).cast("long")))
    group = ["_id", "_source", "_hash"]
    same = F.col("_id").eqNullSafe(F.col("_i")) & F.col("_source").eqNullSafe(F.col("_o")) & (F.col("_hash") == F.col("_h"))
    shared = with_repetitions(sizes.where("_n > 1"), cuts).groupBy(*group).agg(F.sum("_more").alias("_extra"))
    extra = stored(shared.toDF("_i", "_o", "_h", "_extra"), "mix-extra")
    rows = with_repetitions(inner.drop("doc_id", "source", "text"), cuts)
    if not extra.isEmpty():
        rows = rows.join(small_side(extra), same, "left")
        first = rows.where("_extra > 0").groupBy(*group).agg(F.any_value("_row").alias("_row"), F.max("_extra").alias("_times"))
        rows = rows.withColumn("_more", F.when(F.col("_extra").isNull(), F.col("_more")).otherwise(0))
        taken = rows.select("_row", (F.col("_whole") + F.col("_more")).alias("_times")).unionByName(first.select("_row", "_times"))
    else:
        taken = rows.select("_row", (F.col("_whole") + F.col("_more")).alias("_times"))
    taken = taken.where("_times > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).select("_row.*")
