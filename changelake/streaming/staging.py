"""A flush per table: small tables gather over several micro-batches.

Each micro-batch is classified once and *staged*: its events go to one folder, sorted by
target, and one row per target says how many there are and since when.  A target (a
registered table, the unregistered rows, progress, dead letters) is *released* once it has
gathered ``most_rows`` events or its oldest have waited ``most_seconds``.  All targets that
are due make one commit of the log, which notes up to which stage each was released, so a
busy table is written every time and a quiet one seldom, in larger files.

Both steps list their result last.  A stage that is delivered again after it was listed
writes nothing, and a release that dies is made again under the same commit number.  Times
are kept with the stages, so waiting goes on over a restart.  Releases happen after each
micro-batch; where a feed can fall silent, call ``release`` from a timer as well, from the
same driver.  One writer per log, and not beside ``run_to_log``.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from changelake import files
from changelake.operators.envelope import classify, unpack
from changelake.sinks.log import append_side, clear_commit, write_commit
from changelake.sources.lake import read_commits, read_released, read_stages
from changelake.streaming.ingest import BATCH_SECONDS, target_of, write_tables

# Events per table and seconds until a table is written.
MOST_ROWS, MOST_SECONDS = 1_000, 60

COUNTED = T.StructType([T.StructField("target", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("staged_at", T.TimestampType()), T.StructField("writer", T.StringType())])


def _events_path(base: str, stage_id: int | str) -> str:
    return f"{base}/staging/events/stage_id={stage_id}"


def stage_batch(batch: DataFrame, base: str, stage_id: int, ingest_ts: str | None = None, at: datetime | None = None, writer: str | None = None) -> dict[str, int]:
    """Keep one bounded feed until its tables are due; returns the counts, none if it was listed before.

    A stage that another writer listed is not this one: it is refused.
    """
    spark = batch.sparkSession
    before = read_stages(spark, base).filter(F.col("stage_id") == stage_id).select("writer").first()
    if before is not None:
        if before["writer"] != writer:
            raise ValueError(f"stage {stage_id} of this log was written by another query")
        return {}
    now = at or datetime.now(timezone.utc)
    stamp = ingest_ts if ingest_ts or "received_at" in batch.columns else now.isoformat()
    classified = classify(unpack(batch), stamp).withColumn("_target", target_of())
    path = _events_path(base, stage_id)
    classified.hint("rebalance").sortWithinPartitions("_target").write.mode("overwrite").parquet(path)
    kept = spark.read.schema(classified.schema).parquet(path)
    counts = {r["_target"]: r["n"] for r in kept.groupBy("_target").agg(F.count(F.lit(1)).alias("n")).collect()}
    listed = spark.createDataFrame([(t, n, now, writer) for t, n in counts.items()] or [(None, 0, now, writer)], COUNTED)
    listed.coalesce(1).write.mode("overwrite").parquet(f"{base}/staging/list/stage_id={stage_id}")
    return counts


def waiting(spark: SparkSession, base: str) -> DataFrame:
    """Per target what is staged and not released: ``rows, since, first_stage, last_stage``."""
    released = read_released(spark, base).groupBy("target").agg(F.max("stage_id").alias("_to"))
    staged = read_stages(spark, base).filter(F.col("target").isNotNull()).join(released, "target", "left")
    still = staged.filter(F.col("_to").isNull() | (F.col("stage_id") > F.col("_to")))
    return still.groupBy("target").agg(
        F.sum("rows").alias("rows"), F.min("staged_at").alias("since"), F.min("stage_id").alias("first_stage"), F.max("stage_id").alias("last_stage")
    )


def release(
    spark: SparkSession,
    base: str,
    most_rows: int = MOST_ROWS,
    most_seconds: float = MOST_SECONDS,
    at: datetime | None = None,
    archive: str | None = None,
    writer: str | None = None,
) -> int | None:
    """Commit the targets that are due; returns the commit, None if none is.  ``most_rows=0`` releases all.

    The targets are the registry's tables and three more, so their number is fixed.
    """
    oldest = (at or datetime.now(timezone.utc)) - timedelta(seconds=most_seconds)
    due = waiting(spark, base).filter((F.col("rows") >= most_rows) | (F.col("since") <= F.lit(oldest))).collect()
    if not due:
        return None
    commit_id = (read_commits(spark, base).agg(F.max("commit_id")).first()[0] or 0) + 1
    mine = [(F.col("_target") == r["target"]) & F.col("stage_id").between(r["first_stage"], r["last_stage"]) for r in due]
    events = spark.read.option("basePath", f"{base}/staging/events").parquet(_events_path(base, "*")).filter(reduce(or_, mine))
    counts = {r["target"]: r["rows"] for r in due}
    clear_commit(spark, base, commit_id, archive)
    write_tables(events, counts, base, commit_id, archive)
    levels = spark.createDataFrame([(r["target"], r["last_stage"]) for r in due], "target string, stage_id long")
    append_side(levels, base, "released", commit_id)
    write_commit(spark, base, commit_id, counts, "append", None, writer)
    return commit_id


def vacuum_stages(spark: SparkSession, base: str) -> int:
    """Delete the events of stages that are released whole, except the newest; returns how many.

    Their list rows stay: a stage that is delivered again is still known.
    """
    first, newest = waiting(spark, base).agg(F.min("first_stage")).first()[0], read_stages(spark, base).agg(F.max("stage_id")).first()[0]
    kept = min(x for x in (first, newest) if x is not None) if newest is not None else 0
    old = [p for p in files.matching(spark, _events_path(base, "*")) if int(p.rsplit("=", 1)[1]) < kept]
    for path in old:
        files.delete(spark, path)
    return len(old)


def run_staged(
    stream: DataFrame,
    base: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    ingest_ts: str | None = None,
    most_rows: int = MOST_ROWS,
    most_seconds: float = MOST_SECONDS,
    archive: str | None = None,
) -> StreamingQuery:
    """Stage every micro-batch of a feed and release what is due after it.

    Keep the checkpoint with the log: a query without it would take its batches for
    stages that are listed already, so a log whose stages another query wrote is refused.
    """
    started = False

    def land(batch: DataFrame, batch_id: int) -> None:
        nonlocal started
        spark = batch.sparkSession
        newest = read_stages(spark, base).agg(F.max("stage_id")).first()[0]
        if not started and newest is not None and batch_id < newest:
            raise ValueError(f"the checkpoint continues at stage {batch_id}, the log already has {newest}")
        started = True
        writer = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        stage_batch(batch, base, batch_id, ingest_ts, writer=writer)
        release(spark, base, most_rows, most_seconds, archive=archive, writer=writer)
        vacuum_stages(spark, base)

    chosen = trigger or {"processingTime": f"{BATCH_SECONDS} seconds"}
    return stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint or f"{base}/_checkpoint").trigger(**chosen).start()
