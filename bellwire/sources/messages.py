"""Message topics as streams, and the options they need.

Connection settings are arguments; nothing is read from the environment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwire.functions import messages as M


def topic_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
    fail_on_loss: bool = True,
) -> dict[str, str]:
    """Options of a Kafka source."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def message_stream(
    spark: SparkSession, fmt: str, schema: str | None = None, path: str | None = None, **options: str
) -> DataFrame:
    """An append stream of messages from a topic (``kafka``) or a folder."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def decoded(stream: DataFrame) -> DataFrame:
    """``value`` as text, with the position of each message where the source has one."""
    keep = [c for c in ("topic", "partition", "offset") if c in stream.columns]
    return stream.select(F.col("value").cast("string").alias("value"), *keep)


def send(rows: DataFrame, servers: str, topic: str) -> None:
    """Rows to a topic as JSON messages."""
    (
        M.payload(rows)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
