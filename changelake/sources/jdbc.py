"""The live operational table over JDBC.

Filters and column lists travel to the database.  Text columns such as the key
are cast once here, so later joins compare plain text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changelake.schemas import REGISTRY, TableSpec


def options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Reader options; a range-partitioned read needs all four range arguments."""
    chosen = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    ranged = (partition_column, lower, upper, num_partitions)
    if any(v is not None for v in ranged):
        if any(v is None for v in ranged):
            raise ValueError("partition_column, lower, upper and num_partitions go together")
        chosen |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(num_partitions),
        }
    return chosen


def as_registered(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The registered columns in their registered types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in spec.columns.fields])


def read_live(spark: SparkSession, url: str, table: str, registered: str = "expenses", **partitioning) -> DataFrame:
    """The live table, read in parallel ranges when a partition column is given."""
    df = spark.read.format("jdbc").options(**options(url, table, **partitioning)).load()
    return as_registered(df, REGISTRY[registered])
