"""Session settings the library relies on, and a local session for trial runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Times are compared across engines, so the session speaks UTC; AQE coalesces
# small shuffle partitions and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Recording the call site of every Column costs more than building small plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(name: str, cores: int = 8, root: str | None = None, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session; ``root`` holds what a cluster keeps in its shared folder."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(cores),
        **extra,
    }
    if root is not None:
        settings["spark.checkpoint.dir"] = f"{root}/checkpoints"
        settings["spark.sql.warehouse.dir"] = f"{root}/warehouse"
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
