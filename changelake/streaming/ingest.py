"""A streaming feed lands in the change log, one commit per micro-batch.

Micro-batch ``b`` becomes commit ``b + 1``.  Rows are written first and the
commit is listed last; a batch that fails is replayed by Spark from its
checkpoint and clears what it had written under its number in any table.  Keep the checkpoint with the log
it feeds: commit numbers continue from it, and a query that would replace a
commit it did not write is refused.  Each commit also keeps what it took in (files, or the
last offset per topic partition), so ``resume=True`` lets a query whose checkpoint was lost
go on after the newest commit: it reads its source from the start and leaves out what
listed commits already have.  A change without a time gets the time its
body arrived, which a replay finds again.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from changelake.operators.envelope import DATA, DEAD, PROGRESS, classify, split, unpack
from changelake.operators.shaping import member_types, typed_rows
from changelake.schemas import META_COLUMNS, REGISTRY
from changelake.sinks.archive import write_archive
from changelake.sinks.log import append_log, append_side, clear_commit, write_commit
from changelake.sinks.partials import write_partials
from changelake.sources.lake import OTHER, OTHER_TYPES, read_commits, read_intake

# How much one micro-batch takes and how long it may wait.
BATCH_SECONDS = 60


def write_batch(
    batch: DataFrame,
    base: str,
    commit_id: int,
    ingest_ts: str | None = None,
    archive: str | None = None,
    writer: str | None = None,
    resume: bool = False,
) -> dict[str, int]:
    """Normalize one bounded feed and commit it; returns the row counts.

    The classified events are kept while the tables are written from them; the
    table names come from the registry, so their number is fixed.  ``archive``
    also files the rows under the day of their change.  ``resume`` leaves out events
    of files or offsets that a listed commit took in.
    """
    if resume and "source" not in batch.columns:
        raise ValueError("this feed does not say where its bodies came from, so it cannot go on without its checkpoint")
    stamp = ingest_ts if ingest_ts or "received_at" in batch.columns else datetime.now(timezone.utc).isoformat()
    met = _met(batch, base) if resume else batch.withColumn("_taken", F.lit(False))
    # What a listed commit has is left out as text, before its bodies are parsed.
    fresh = met.filter(~F.col("_taken")).drop("_taken")
    classified = classify(unpack(fresh), stamp).withColumn("_target", target_of()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = {r["_target"]: r["n"] for r in classified.groupBy("_target").agg(F.count(F.lit(1)).alias("n")).collect()}
        clear_commit(batch.sparkSession, base, commit_id, archive)
        if "source" in classified.columns:
            append_side(_intake(classified, met.filter("_taken") if resume else None), base, "intake", commit_id)
        write_tables(classified, counts, base, commit_id, archive)
        write_commit(batch.sparkSession, base, commit_id, counts, "append", None, writer)
    finally:
        classified.unpersist()
    return counts


def target_of() -> Column:
    """Where a classified event goes: a registered table, the unregistered rows, progress or dead letters."""
    registered = F.when(F.col("cdc_table").isin(*REGISTRY), F.col("cdc_table")).otherwise(F.lit(OTHER))
    return F.when(F.col("kind") == DATA, registered).otherwise(F.col("kind"))


def write_tables(events: DataFrame, counts: dict[str, int], base: str, commit_id: int, archive: str | None = None) -> None:
    """Write a commit's classified events to the tables that ``counts`` names; the commit is not listed yet."""
    found = split(events)
    for table in (t for t in REGISTRY if t in counts):
        rows = typed_rows(found.rows, table)
        append_log(rows, base, table, commit_id)
        if table == "expenses":
            write_partials(rows, base, commit_id)
        if archive:
            write_archive(rows.drop("feed"), archive, table, F.col("cdc_ts"), commit_id)
    if OTHER in counts:
        unregistered = found.rows.filter(~F.col("cdc_table").isin(*REGISTRY)).select("feed", *META_COLUMNS, "cdc_ts", "cdc_seq", "row")
        append_side(unregistered, base, f"log/{OTHER}", commit_id)
        append_side(member_types(unregistered), base, OTHER_TYPES, commit_id)
        if archive:
            write_archive(unregistered.withColumn("body", F.to_json("row")).drop("row"), archive, OTHER, F.col("cdc_ts"), commit_id)
    if PROGRESS in counts:
        append_side(found.progress, base, "progress", commit_id)
    if DEAD in counts:
        append_side(found.dead, base, "dead", commit_id)


def _intake(events: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """One row per file, or per topic partition with its last offset; bodies without events count as not taken."""
    position = F.col("position") if "position" in events.columns else F.lit(None).cast("bigint")
    told = events.select("source", position.alias("position"))
    if taken is not None:
        told = told.unionByName(taken.select("source", position.alias("position")))
    return told.groupBy("source").agg(F.max("position").alias("position"))


def _met(batch: DataFrame, base: str) -> DataFrame:
    """The batch, each body marked ``_taken`` if it is from a file or an offset that a listed commit has.

    Only the batch's own sources are looked up, at most as many as a batch has files or
    topic partitions, so they go to every task and the bodies stay where they are.  Bodies
    that do not say where they came from are not taken.
    """
    own = batch.select("source").distinct()
    taken = read_intake(batch.sparkSession, base).join(own, "source", "left_semi").groupBy("source").agg(F.max("position").alias("_taken_to"))
    within = F.coalesce(F.col("position") <= F.col("_taken_to"), F.lit(True)) if "position" in batch.columns else F.lit(True)
    joined = batch.join(F.broadcast(taken.withColumn("_known", F.lit(True))), "source", "left")
    return joined.select(*batch.columns, (F.col("_known").isNotNull() & within).alias("_taken"))


def first_commit(batch: DataFrame, base: str, batch_id: int, writer: str | None) -> int:
    """Commit number of a resuming query's batch 0: one after the log it found.

    A query lists every batch, so its first commit tells the number.  One that has no
    commit yet must be at its first batch, and what the log has must say what it took in.
    """
    spark = batch.sparkSession
    commits = read_commits(spark, base)
    first, newest = commits.agg(F.min(F.when(F.col("writer") == writer, F.col("commit_id"))), F.max("commit_id")).first()
    if first is not None or newest is None:
        return first or 1
    if batch_id:
        raise ValueError(f"the checkpoint is at batch {batch_id}, but the log has no commit of this query")
    untold = commits.filter(F.size("summary") > 0).join(read_intake(spark, base), "commit_id", "left_anti")
    if not untold.isEmpty():
        raise ValueError("the log has commits that do not say what they took in; their rows would be doubled")
    return newest + 1


def is_listed(batch: DataFrame, base: str, commit_id: int, writer: str | None) -> bool:
    """Whether a query's first batch is a replay of a commit it has already listed.

    Only the newest commit can be one, and only by the query that wrote it.  It holds the
    same offsets, so there is nothing to write.  Any other number that is not new means
    that the checkpoint was lost or belongs to another log: writing would replace rows that
    are already committed, so the query is stopped.
    """
    commits = read_commits(batch.sparkSession, base)
    newest, last = commits.agg(F.max("commit_id"), F.max_by("writer", "commit_id")).first()
    if newest is not None and (commit_id < newest or commit_id == newest and writer != last):
        raise ValueError(f"the checkpoint continues at commit {commit_id}, the log already has {newest}")
    return newest is not None and commit_id == newest


def run_to_log(
    stream: DataFrame,
    base: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    ingest_ts: str | None = None,
    archive: str | None = None,
    resume: bool = False,
) -> StreamingQuery:
    """Start landing a streaming feed below ``base``, and in ``archive`` if given.

    ``trigger`` is what ``DataStreamWriter.trigger`` takes; the default starts
    a batch every minute.  With ``resume`` a query with a new checkpoint goes on after
    the newest commit; give it at every later start of that query too.
    """
    chosen = trigger or {"processingTime": f"{BATCH_SECONDS} seconds"}
    started, zero = False, 1  # zero: commit number of batch 0

    def land(batch: DataFrame, batch_id: int) -> None:
        nonlocal started, zero
        # The id is kept in the checkpoint, so it outlives restarts.
        writer = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if resume and not started:
            zero = first_commit(batch, base, batch_id, writer)
        replayed = not started and is_listed(batch, base, zero + batch_id, writer)
        started = True
        if replayed:
            return
        write_batch(batch, base, zero + batch_id, ingest_ts, archive, writer, resume)

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint or f"{base}/_checkpoint")
        .trigger(**chosen)
        .start()
    )


def run_available(
    stream: DataFrame,
    base: str,
    checkpoint: str | None = None,
    ingest_ts: str | None = None,
    timeout: int | None = None,
    archive: str | None = None,
    resume: bool = False,
) -> StreamingQuery:
    """Land everything that is there now, then stop; ``timeout`` (seconds) is off unless given."""
    query = run_to_log(stream, base, checkpoint, {"availableNow": True}, ingest_ts, archive, resume)
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"the feed was not landed within {timeout} s")
    return query


def drain(query: StreamingQuery) -> None:
    """Land what has arrived so far and stop the query."""
    query.processAllAvailable()
    query.stop()
