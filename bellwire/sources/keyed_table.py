"""Stored tables whose rows are patched by key: only the buckets that a patch touches are written again.

A table is a folder::

    data/at_bucket=B/at_version=N/   the rows of bucket B as of patch N
    marks/mark=N/                    one small file: the buckets that patch N wrote, and the columns since then

A row's bucket is a hash of its key. A patch writes its buckets beside the old ones and then its mark, one file
that appears at once; readers take of each bucket the last version that has a mark. So a patch that fails
halfway is never seen, one that is run again replaces what it wrote, and readers of the old version keep their files.
Tables have one writer at a time.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwire.operators.scans import keyed_update
from bellwire.session import settled

BUCKETS = 64
MARK = "version LONG, bucket INT, columns STRING"


@dataclass
class KeyedTable:
    """A stored table with unique keys; ``buckets`` is fixed when it is made."""

    spark: SparkSession
    path: str
    key: str
    buckets: int = BUCKETS

    def bucket(self, rows: DataFrame) -> Column:
        """The bucket of a row; rows without a key match no patch and are spread by all their columns."""
        key = F.col(self.key)
        spread = F.when(key.isNull(), F.xxhash64(*rows.columns)).otherwise(F.xxhash64(key))
        return F.pmod(spread, F.lit(self.buckets)).cast("int")

    def _marks(self) -> DataFrame:
        return self.spark.read.schema(MARK).parquet(f"{self.path}/marks")

    def versions(self) -> tuple[int, dict[int, int], T.StructType | None]:
        """The last version, the version of each bucket, and the columns: one row per bucket is read."""
        try:
            marks = self._marks()
        except AnalysisException:
            return -1, {}, None
        rows = marks.groupBy("bucket").agg(F.max("version").alias("version")).collect()
        last = marks.agg(F.max_by("columns", "version"), F.max("version")).first()
        found = {r["bucket"]: r["version"] for r in rows}
        return last[1], found, T.StructType.fromJson(json.loads(last[0]))

    def _write(self, rows: DataFrame, version: int, touched: DataFrame) -> None:
        """Writes whole buckets, then the mark that makes them the current ones."""
        placed = rows.withColumns({"at_bucket": self.bucket(rows), "at_version": F.lit(version).cast("long")})
        (
            placed.hint("rebalance", "at_bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("at_bucket", "at_version")
            .parquet(f"{self.path}/data")
        )
        mark = touched.select(
            F.lit(version).cast("long").alias("version"), "bucket", F.lit(rows.schema.json()).alias("columns")
        )
        # At most one row per bucket, in one file, so that all of them count from one moment on.
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/mark={version}")

    def create(self, rows: DataFrame) -> None:
        """Stores all rows as the first version; a table that is there already is an error."""
        if self.versions()[0] >= 0:
            raise ValueError(f"there is a table at {self.path}")
        every = self.spark.range(self.buckets).select(F.col("id").cast("int").alias("bucket"))
        self._write(rows, 0, every)

    def read(self, only: list[int] | None = None) -> DataFrame:
        """The current rows (of some buckets); columns that a later patch added are null in older buckets."""
        _, found, columns = self.versions()
        if columns is None:
            raise ValueError(f"there is no table at {self.path}")
        wanted = [b for b in found if only is None or b in only]
        by_version: dict[int, list[int]] = {}
        for b in wanted:
            by_version.setdefault(found[b], []).append(b)
        current = F.lit(False)
        for version, some in sorted(by_version.items()):
            current = current | ((F.col("at_version") == version) & F.col("at_bucket").isin(some))
        # Both are folder names, so only the files of current buckets are read.
        whole = T.StructType([*columns.fields, *T.StructType.fromDDL("at_bucket INT, at_version LONG").fields])
        stored = self.spark.read.schema(whole).parquet(f"{self.path}/data").where(current)
        return stored.select(*[F.col(f"`{c}`") for c in columns.names])

    def patch(self, changes: DataFrame, insert: bool = False) -> list[int]:
        """Sets the columns of ``changes`` on the rows of their keys; the buckets that were written.

        Values set to null become null; columns that only ``changes`` has are added. Keys that the table lacks are left
        out, or added with ``insert``; a null key matches nothing. A key that occurs twice fails the patch before
        anything is written. Buckets without a key of the patch are neither read nor written.
        """
        last, found, columns = self.versions()
        if columns is None:
            raise ValueError(f"there is no table at {self.path}")
        fields = [c for c in changes.columns if c != self.key]
        once = (
            changes.where(F.col(self.key).isNotNull())
            .groupBy(self.key)
            .agg(F.count("*").alias("_times"), F.any_value(F.struct(*fields)).alias("_set"))
        )
        twice = F.raise_error(F.concat(F.lit("key occurs twice: "), F.col(self.key).cast("string")))
        ok = F.when(F.col("_times") == 1, F.col("_set")).otherwise(twice)
        # Equal keys have one hash only if their types are the same.
        key = F.col(self.key).cast(columns[self.key].dataType).alias(self.key)
        unique = settled(once.select(key, ok.alias("_set")).select(self.key, "_set.*"))
        touched = unique.select(self.bucket(unique).alias("bucket")).distinct()
        wanted = sorted(r["bucket"] for r in touched.collect())
        if not wanted:
            return []
        base = self.read(wanted)
        rows = keyed_update(base, unique, self.key)
        if insert:
            new = unique.join(base.select(self.key), self.key, "left_anti")
            rows = rows.unionByName(new, allowMissingColumns=True)
        kept = self.spark.createDataFrame([(b,) for b in wanted], "bucket INT")
        self._write(rows, last + 1, kept)
        return wanted

    def update_one(self, where: Column, values: dict[str, Column]) -> list[int]:
        """Sets values on the first row, by key, that meets a condition."""
        rows = self.read()
        first = rows.where(where).orderBy(self.key).limit(1)
        return self.patch(first.select(self.key, *[c.alias(n) for n, c in values.items()]))
