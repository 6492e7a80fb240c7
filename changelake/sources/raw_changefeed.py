"""Parquet files a change feed wrote by itself, without this library.

Files sit in one folder per day, next to marker files that are not Parquet.
Deleted rows carry only their key; the other columns come from the image before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.functions.event_time import parse_event_time
from changelake.functions.rows import operation_name
from changelake.schemas import RAW_BEFORE, RAW_EVENT_TYPE, RAW_UPDATED, REGISTRY


def read_raw_changefeed(spark: SparkSession, path: str, table: str = "expenses") -> DataFrame:
    """Change-log rows of a raw feed, plus the day folder each came from."""
    spec = REGISTRY[table]
    found = spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    # Days may have different columns; the columns of all footers count, not those of one.
    files = found.option("mergeSchema", "true").parquet(path)
    day = F.regexp_extract("_metadata.file_path", r"/(\d{4}-\d{2}-\d{2})/", 1).cast("date")
    if RAW_BEFORE in files.columns:
        gone = F.when(F.col(RAW_EVENT_TYPE) == "d", F.try_parse_json(RAW_BEFORE))
        before = F.try_variant_get(gone, "$", spec.columns.simpleString())
    else:
        before = F.lit(None).cast(spec.columns)
    opened = files.select("*", day.alias("file_date"), before.alias("_before"))
    columns = []
    for f in spec.columns.fields:
        earlier = F.col(f"_before.{f.name}")
        own = F.col(f.name).cast(f.dataType) if f.name in files.columns else earlier
        columns.append(F.coalesce(own, earlier).alias(f.name))
    extra = [c for c in ("tags", "created_at") if c in files.columns]
    return parse_event_time(
        opened.select(
            *columns,
            *extra,
            F.lit(table).alias("cdc_table"),
            operation_name(F.col(RAW_EVENT_TYPE)).alias("cdc_operation"),
            F.col(RAW_UPDATED).cast("string").alias("cdc_timestamp"),
            "file_date",
        )
    )
