"""Versions of the change log: what each commit added, and the log as of one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.functions.sized import top_k
from changelake.operators.reports import rows, total


def list_commits(commits: DataFrame, n: int | None = None) -> DataFrame:
    """Commits, newest first."""
    return top_k(commits, n, F.desc("committed_at"), F.desc("commit_id"))


def as_of(log: DataFrame, commit_id: int) -> DataFrame:
    """The log as it stood after a commit; later commit folders are skipped."""
    return log.filter(F.col("commit_id") <= commit_id)


def history(commits: DataFrame) -> DataFrame:
    """The chain of versions and which one is current."""
    newest = commits.agg(F.max("commit_id").alias("newest")).scalar()
    return commits.select(
        F.col("committed_at").alias("made_current_at"),
        "commit_id",
        "parent_id",
        (F.col("commit_id") == newest).alias("is_current"),
    ).orderBy("commit_id")


def file_inventory(table: DataFrame, *columns: str) -> DataFrame:
    """Rows and bytes of every data file, with its partition columns.

    ``table`` is a file-backed DataFrame, of which only partition columns are read, or
    one with the columns ``file_path`` and ``file_bytes`` (``read_log(with_files=True)``).
    """
    named = "file_path" in table.columns and "file_bytes" in table.columns
    files = table.select(*columns, "file_path", "file_bytes") if named else table.select(*columns, F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_bytes"))
    return files.groupBy(*columns, "file_path", "file_bytes").agg(rows().alias("record_count"))


def _file_totals(table: DataFrame, *columns: str) -> DataFrame:
    return (
        file_inventory(table, *columns)
        .groupBy(*columns)
        .agg(
            F.sum("record_count").alias("record_count"),
            rows().alias("file_count"),
            F.sum("file_bytes").alias("total_bytes"),
        )
    )


def partition_stats(table: DataFrame, *columns: str) -> DataFrame:
    """Rows, files and bytes per partition."""
    return _file_totals(table, *columns).orderBy(*columns)


def files_per_commit(log: DataFrame) -> DataFrame:
    """Files, rows and bytes each commit added."""
    return _file_totals(log, "commit_id").orderBy("commit_id")


def compare_generations(snap: DataFrame) -> DataFrame:
    """Rows and spending per snapshot generation, newest first."""
    return (
        snap.groupBy("snapshot_timestamp")
        .agg(rows().alias("row_count"), total().alias("total_spend"))
        .orderBy(F.desc("snapshot_timestamp"))
    )
