"""Change events from message topics.

Needs the Spark Kafka connector on the class path at deployment.  The decoding
step is separate, so it also serves any other source of binary messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def decode(messages: DataFrame) -> DataFrame:
    """Binary message values as a feed; the topic names the feed, its partition and offset say where a message was."""
    feed = F.col("topic") if "topic" in messages.columns else F.lit("default")
    arrived = [F.col("timestamp").alias("received_at")] if "timestamp" in messages.columns else []
    origin = []
    if {"topic", "partition", "offset"} <= set(messages.columns):
        origin = [F.concat_ws("/", "topic", "partition").alias("source"), F.col("offset").cast("bigint").alias("position")]
    return messages.select(feed.alias("feed"), F.col("value").cast("string").alias("value"), *arrived, *origin)


def options(
    brokers: str, topics: list[str], starting: str = "earliest", max_offsets: int | None = None, **extra: str
) -> dict[str, str]:
    """Source options; offsets live in the query's checkpoint, not in a consumer group."""
    if not topics:
        raise ValueError("name at least one topic")
    chosen = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        **extra,
    }
    if max_offsets is not None:
        chosen["maxOffsetsPerTrigger"] = str(max_offsets)
    return chosen


def stream_kafka(
    spark: SparkSession, brokers: str, topics: list[str], starting: str = "earliest", max_offsets: int | None = None, **extra: str
) -> DataFrame:
    """A streaming feed of the topics, ``max_offsets`` messages per batch."""
    reader = spark.readStream.format("kafka").options(**options(brokers, topics, starting, max_offsets, **extra))
    return decode(reader.load())


def read_kafka(spark: SparkSession, brokers: str, topics: list[str], starting: str = "earliest", **extra: str) -> DataFrame:
    """The same topics as a bounded feed."""
    return decode(spark.read.format("kafka").options(**options(brokers, topics, starting, **extra)).load())
