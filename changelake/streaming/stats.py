"""Counters of a running or finished ingest."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stats(log: DataFrame, commits: DataFrame) -> DataFrame:
    """Events in the log and commits that brought them."""
    flushes = commits.agg(F.count(F.lit(1)).alias("n")).scalar()
    return log.agg(F.count(F.lit(1)).alias("total_events")).withColumn("total_flushes", flushes)


def ingest_counts(commits: DataFrame) -> DataFrame:
    """What the commits say: batches, events taken in, and events of the newest batch.

    The commits hold every batch; a query's own progress reports are only its newest.
    """
    taken = F.aggregate(F.map_values("summary"), F.lit(0).cast("bigint"), lambda n, v: n + v.cast("bigint"))
    return commits.agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum(taken), F.lit(0)).alias("events"),
        F.coalesce(F.max_by(taken, "commit_id"), F.lit(0)).alias("events_in_last_batch"),
    )


def pending(progress: dict) -> int | None:
    """Messages a source still holds, over all its partitions, by a progress report; None if it does not say."""
    known = [n for n in map(_behind, progress.get("sources", [])) if n is not None]
    return sum(known) if known else None


def _behind(source: dict) -> int | None:
    latest, end = (json.loads(o) if isinstance(o, str) else o for o in (source.get("latestOffset"), source.get("endOffset")))
    if not isinstance(latest, dict) or not all(isinstance(parts, dict) for parts in latest.values()):
        return None
    return sum(int(n) - int(((end or {}).get(topic) or {}).get(part, 0)) for topic, parts in latest.items() for part, n in parts.items())
