"""Folders on any Hadoop file system, handled from the driver: names only, never contents."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    where = _path(spark, pattern)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return sorted(s.getPath().toString() for s in found) if found else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all below it, if it is there."""
    where = _path(spark, path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
