"""Create and reset the catalog tables of the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changelake.schemas import META_COLUMNS, REGISTRY
from changelake.sources.catalog import table_row_counts

SNAPSHOT_TABLE = "expenses_snapshot"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def create_table_sql(database: str, table: str) -> str:
    spec = REGISTRY[table]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in spec.columns.fields]
    columns += [f"`{c}` string" for c in META_COLUMNS]
    layout = f" PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
    return f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({', '.join(columns)}) USING parquet{layout}"


def ensure_tables(
    spark: SparkSession, database: str, location: str | None = None, tables: list[str] | None = None
) -> list[str]:
    """Create the database and the registered tables that do not exist yet."""
    create_database(spark, database, location)
    names = tables or list(REGISTRY)
    for table in names:
        spark.sql(create_table_sql(database, table))
    return [f"`{database}`.`{t}`" for t in names]


def reset_tables(spark: SparkSession, database: str, tables: list[str] | None = None) -> DataFrame:
    """Drop and recreate tables; the returned counts are all zero.

    Resetting the expenses also drops the snapshot made of them.
    """
    names = tables or list(REGISTRY)
    for table in [*names, *([SNAPSHOT_TABLE] if "expenses" in names else [])]:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
    return table_row_counts(spark, ensure_tables(spark, database, tables=names))
