"""Session settings, shared storage and checked broadcasts."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side may have, and bytes its text may take, and still be broadcast.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

# The setting for the bytes of a batch between the JVM and Python, and what it needs at most where texts are taken a
# chunk of about 1 MB at a time: larger batches only take memory on both sides.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "4m"

# The setting by which an execution's shuffle files are removed when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    BATCH: BATCH_BYTES,
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Per-feed caps of 10,000 rows are applied before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # GBK word lists need the full JDK charset set.
    "spark.sql.legacy.javaCharsets": "true",
}


def build_session(
    app: str = "bellwire",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with UTC wall-clock time, AQE and skew-join splitting on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_batches(spark: SparkSession) -> None:
    """Bounds the batches between the JVM and Python for the rest of the session, if nobody has set their size.

    Unbounded, a batch holds 10,000 texts or 64 MB, several times over on both sides of each task.
    """
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that
    folder would exist on one machine and be lost with it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="bellwire-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once into reliable storage, its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a columnar table below the shared folder.

    For large intermediates that are read several times with few columns each. The
    table stays until its folder is removed; checkpoints go with their session.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is executed meanwhile leaves no shuffle files behind.

    Else they stay until the driver happens to collect its garbage, and those of a loop add up. What is read again after that must
    be stored or persisted.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Rounds:
    """Storage for the results of a loop: each replaces the one before the last, so two are kept.

    Columnar files cut the lineage, and unlike a checkpoint also the planner's estimates, which are multiplied with
    every join of a loop. The shuffles that a result came by go when it is stored.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.paths = [scratch_path(spark, name) for _ in range(2)]

    def kept(self, df: DataFrame) -> DataFrame:
        """``df`` stored; it may read what was kept last, but nothing older."""
        self.paths.reverse()
        with shuffles_removed(self.spark):
            df.write.mode("overwrite").parquet(self.paths[0])
        return self.spark.read.schema(df.schema).parquet(self.paths[0])

    def close(self) -> None:
        """Removes what was kept."""
        for path in self.paths:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def is_small(kept: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether ``kept``, which is read for it, has few rows and bytes enough to be broadcast."""
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    width = sum(
        (
            F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
            for f in kept.schema.fields
        ),
        F.lit(0),
    )
    size = kept.agg(F.count("*").alias("n"), F.sum(width).alias("b")).first()
    return size["n"] <= max_rows and (size["b"] or 0) <= max_bytes


def small_side(
    df: DataFrame,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """``df`` settled, with a broadcast hint only if it was measured to be small.

    Meant for pre-aggregated sides (one row per source, symbol or word). Beyond
    the bounds no hint is given, and the planner shuffles both sides with
    adaptive skew splitting.
    """
    kept = settled(df)
    return F.broadcast(kept) if is_small(kept, max_rows, max_bytes) else kept
