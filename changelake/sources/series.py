"""Rows made in the program: a number series and literal rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def series(spark: SparkSession, n: int) -> DataFrame:
    """The numbers 1..n in column ``g``, made on the executors."""
    return spark.range(1, n + 1).select(F.col("id").alias("g"))


def literal_rows(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A few rows given in the program."""
    return spark.createDataFrame(rows, schema)
