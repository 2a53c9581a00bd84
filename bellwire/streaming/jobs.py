"""News and bar streams.

Every sink writes below ``.../batch_id=N`` and overwrites, so a batch that is run
again after a failure replaces its own output and nothing is stored twice. Sources
keep their offsets in the checkpoint of the query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bellwire.functions import messages as M

# Fixed value: seconds between two polls for new items.
POLL_SECONDS = 3600


def poll_trigger(seconds: int = POLL_SECONDS) -> dict[str, str]:
    """Trigger of a live job."""
    return {"processingTime": f"{seconds} seconds"}


def drain_trigger() -> dict[str, bool]:
    """Trigger of a job that takes what is there and ends; run it again for more."""
    return {"availableNow": True}


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def offset_audit(batch: DataFrame) -> DataFrame:
    """First and last offset and message count per source partition."""
    return batch.groupBy("partition").agg(
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        F.count("*").alias("n"),
    )


def batch_counters(checked: DataFrame) -> DataFrame:
    """Progress of one batch: messages, those accepted and those refused, and the refusals by reason."""
    reasons = F.map_from_entries(
        F.array(*[F.struct(F.lit(r), F.count_if(F.col("reason") == r)) for r in M.REASONS])
    )
    return checked.agg(
        F.count("*").alias("messages"),
        F.count_if(F.col("reason").isNull()).alias("accepted"),
        F.count_if(F.col("reason").isNotNull()).alias("refused"),
        reasons.alias("reasons"),
    )


def ingest_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Sink of one micro-batch: accepted news, dead letters and offsets.

    The work stays on the executors; each message is parsed once, and the judged batch is kept
    while its parts are written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = M.checked(batch).persist()
        try:
            write_batch(M.accepted(kept), f"{path}/news", batch_id)
            write_batch(M.refused(kept), f"{path}/dead_letters", batch_id)
            write_batch(batch_counters(kept), f"{path}/counters", batch_id)
            if {"partition", "offset"} <= set(kept.columns):
                write_batch(offset_audit(kept), f"{path}/offsets", batch_id)
        finally:
            kept.unpersist()

    return write


def start_ingest(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Parse, validate, clean and store a message stream."""
    return (
        messages.writeStream.foreachBatch(ingest_batch(path))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or poll_trigger()))
        .start()
    )


def newer_than(items: DataFrame, marks: DataFrame | None, source: str, time: str) -> DataFrame:
    """Items after the mark of their source; undated items and new sources pass."""
    if marks is None:
        return items
    known = marks.withColumnRenamed("latest", "_latest")
    undated = F.col(time).isNull() | (F.col(time).cast("string") == "")
    return (
        items.join(known, source, "left")
        .where(undated | F.col("_latest").isNull() | (F.col(time) > F.col("_latest")))
        .drop("_latest")
    )


def raised_marks(
    items: DataFrame, marks: DataFrame | None, source: str, time: str
) -> DataFrame:
    """The greatest time per source, partially aggregated: one row per source moves."""
    dated = items.where(F.col(time).cast("string") != "").select(
        source, F.col(time).alias("latest")
    )
    both = dated if marks is None else dated.unionByName(marks)
    return both.groupBy(source).agg(F.max("latest").alias("latest"))


def high_water_batch(
    spark: SparkSession, path: str, source: str, time: str
) -> Callable[[DataFrame, int], None]:
    """Sink that stores only items newer than what their source has sent before.

    Items are compared with the marks at the start of the batch, so their order
    inside it does not matter. The marks are a small versioned table, one row per
    source, which the planner broadcasts by its size: a hot source is filtered where
    its rows are and never gathered into one state group.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        marks = None
        if batch_id > 0:
            marks = spark.read.parquet(f"{path}/marks/batch_id={batch_id - 1}")
        kept = batch.persist()
        try:
            write_batch(newer_than(kept, marks, source, time), f"{path}/items", batch_id)
            write_batch(raised_marks(kept, marks, source, time), f"{path}/marks", batch_id)
        finally:
            kept.unpersist()

    return write


def start_high_water(
    items: DataFrame,
    path: str,
    checkpoint: str,
    source: str = "feed",
    time: str = "news_time",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store only new items of each source, across polls and restarts."""
    sink = high_water_batch(items.sparkSession, path, source, time)
    return (
        items.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or poll_trigger()))
        .start()
    )


def daily_once(snapshots: DataFrame, delay: str = "1 day") -> DataFrame:
    """A stream with at most one snapshot per symbol and day.

    State older than the watermark is dropped; it must outlive a trading day.
    """
    dated = snapshots.withColumn("date", F.to_date("ts"))
    return dated.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["symbol", "date"])


def start_append(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream to a folder with the exactly-once file sink."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or poll_trigger()))
        .start()
    )
