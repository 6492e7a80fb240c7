"""Shared folders for everything a job has to write between its stages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="changelake-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def fresh(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/changelake/{name}-{uuid.uuid4().hex}"
