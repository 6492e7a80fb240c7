"""The dated Parquet archive: ``year=/month=/day=`` folders per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.sources.lake import OTHER, archive_path

DATE_PARTS = ("year", "month", "day")


def dated(df: DataFrame, date: Column | None = None) -> DataFrame:
    """Add the folder columns; the day the job runs (UTC) unless given."""
    day = F.current_date() if date is None else date
    return df.withColumns(
        {"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"), "day": F.date_format(day, "dd")}
    )


def write_archive(
    df: DataFrame, base: str, table: str, date: Column | None = None, commit_id: int | None = None
) -> str:
    """Append rows to a table's archive and return its folder.

    ``base`` is any Hadoop file-system URI.  Rows are rebalanced by day, so a
    day becomes a few well-sized files and a very large day is split over
    several tasks instead of landing in one.  Each commit has a folder below
    each day, and writing the commit again replaces those folders only; that
    needs a ``date`` taken from the rows.  Rows of a job without commits are
    appended to folder 0.  ``table`` ``_other`` takes rows of unregistered tables,
    which get a folder per table.
    """
    path = archive_path(base, table)
    mode = "append" if commit_id is None else "overwrite"
    out = dated(df, date).withColumn("commit_id", F.lit(commit_id or 0).cast("bigint")).hint("rebalance", *DATE_PARTS)
    parts = (*(["cdc_table"] if table == OTHER else []), *DATE_PARTS, "commit_id")
    writer = out.write.mode(mode).option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(path)
    return path
