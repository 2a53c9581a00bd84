"""Writers: append, once-only, keyed by symbol, and models."""

from __future__ import annotations

from pyspark.ml.util import MLReader, MLWritable
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append to a collection."""
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """``df`` with counters that are ready once it has been written.

    Rows are always counted; further metrics are aggregate columns. Nothing is read twice.
    """
    counters = Observation(name)
    extra = [column.alias(key) for key, column in metrics.items()]
    return df.observe(counters, F.count(F.lit(1)).alias("rows"), *extra), counters


def append_table(df: DataFrame, name: str) -> None:
    """Append to a catalog table ``database.collection``."""
    df.write.mode("append").saveAsTable(name)


def write_if_absent(df: DataFrame, path: str) -> None:
    """Write only when the path does not exist yet."""
    df.write.mode("ignore").parquet(path)


def write_by_symbol(df: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per symbol.

    Rebalancing gathers each symbol into few files, and splits a hot symbol over
    several tasks instead of giving it to one.
    """
    df.hint("rebalance", "symbol").write.mode(mode).partitionBy("symbol").parquet(path)


def save_model(model: MLWritable, path: str) -> None:
    """Store a fitted model, replacing an older one."""
    model.write().overwrite().save(path)


def load_model(kind: type, path: str):
    """A stored model of a class such as ``PipelineModel``."""
    reader: MLReader = kind.read()
    return reader.load(path)
