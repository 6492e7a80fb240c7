"""Change events that land as text files, one JSON body per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _feed(lines: DataFrame, feed: str) -> DataFrame:
    """Lines with the time their file was written, which a replay finds again, and its path."""
    return lines.select(F.lit(feed).alias("feed"), "value", F.col("_metadata.file_modification_time").alias("received_at"), F.col("_metadata.file_path").alias("source"))


def read_events(spark: SparkSession, path: str, feed: str = "default") -> DataFrame:
    """A bounded feed from landed files."""
    return _feed(spark.read.text(path), feed)


def stream_events(spark: SparkSession, path: str, feed: str = "default", max_files: int = 1000) -> DataFrame:
    """A streaming feed from a landing folder, ``max_files`` files per batch."""
    lines = (
        spark.readStream.schema("value string")
        .option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", "true")
        .text(path)
    )
    return _feed(lines, feed)
