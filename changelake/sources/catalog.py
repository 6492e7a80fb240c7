"""What exists: tables, their row counts, written files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`").select(F.col("tableName").alias("table_name"))


def table_row_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """Row count of each named table, largest first."""
    return named_row_counts(**{n: spark.table(n) for n in names})


def analyze(spark: SparkSession, names: list[str]) -> None:
    """Keep the row counts of catalog tables in the catalog; call it after writing to them."""
    for name in names:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def estimated_row_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """Row count of each named table as the catalog has it, largest first; no file is opened.

    As of the last ``analyze``; null for a table that was never analyzed, or changed by a
    write that made the catalog forget, and for views.
    """
    described = [
        spark.sql(f"DESCRIBE TABLE EXTENDED {name}").select(
            F.lit(name).alias("table_name"),
            F.when(F.col("col_name") == "Statistics", F.nullif(F.regexp_extract("data_type", r"(\d+) rows", 1), F.lit("")).cast("bigint")).alias("row_count"),
        )
        for name in names
    ]
    counts = reduce(DataFrame.unionByName, described).groupBy("table_name").agg(F.max("row_count").alias("row_count"))
    return counts.orderBy(F.desc("row_count"), "table_name")


def named_row_counts(**tables: DataFrame) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy(F.desc("row_count"), "table_name")


def list_output(spark: SparkSession, base: str, n: int | None = 20, pattern: str = "*.parquet") -> DataFrame:
    """The first ``n`` written files by path, each with the total number of files.

    Only paths and sizes are read, never file contents.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(base)
        .select("path", "length", "modificationTime")
    )
    listed = files.withColumn("total_files", files.agg(F.count(F.lit(1)).alias("n")).scalar()).orderBy("path")
    return listed if n is None else listed.limit(n)
