"""Few large files in place of many commit folders.

A job rewrites the rows of a range of listed commits into one *segment*: files of about
``target_bytes``, sorted by key, with ``commit_id`` as a column.  A segment is written first
and listed last, with one row; from then on readers take it instead of the commits in its
range (``lake.read_log``).  Until then they go on with the folders, so the log stays readable
while the job runs, and a job that dies leaves only files nobody lists.

Segments grow by tiers: the new commits are joined by the segments before them that are not
much larger, so each row is rewritten a logarithmic number of times and few segments stay.

Run one compaction of a table at a time; ingest may go on beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake import files
from changelake.schemas import REGISTRY
from changelake.sinks.log import key_filters, rebalanced
from changelake.sources.lake import SEGMENTS, Segment, escaped, log_part, read_commits, read_log, segment_path, segments

TARGET_BYTES = 128 << 20
GROWTH = 2.0  # a segment is rewritten unless it is larger than what follows it by this factor
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _bytes(rows: DataFrame) -> int:
    """Size of the files behind ``rows``; reads footers only."""
    sizes = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    return sizes.agg(F.sum("size")).first()[0] or 0


def compact(spark: SparkSession, base: str, table: str = "expenses", target_bytes: int = TARGET_BYTES, keep: int = 0, growth: float = GROWTH) -> Segment | None:
    """Rewrite all commits but the newest ``keep`` that no segment has; returns the new segment, None if there was nothing to do."""
    active = segments(spark, base, table)
    newest = read_commits(spark, base).agg(F.max("commit_id")).first()[0] or 0
    first, last = (active[-1].last + 1 if active else 1), newest - keep
    if last < first or not files.matching(spark, f"{base}/log/{table}/commit_id=*"):
        return None
    size = _bytes(log_part(spark, base, table).filter(F.col("commit_id").between(first, last)))
    while active and active[-1].bytes <= growth * size:
        joined = active.pop()
        first, size = joined.first, size + joined.bytes
    spec = REGISTRY[table]
    rows = read_log(spark, base, table).filter(F.col("commit_id").between(first, last))
    rows = rows.withColumns({c: escaped(F.col(c)) for c in spec.partition_by})
    rows = rebalanced(rows, spec.partition_by, spec.keys).sortWithinPartitions(*spec.partition_by, *spec.keys, "commit_id")
    path = segment_path(base, table, first, last)
    before = spark.conf.get(ADVISORY, None)
    spark.conf.set(ADVISORY, str(target_bytes))
    try:
        writer = rows.write.mode("overwrite").option("compression", "snappy").options(**key_filters(spec.keys))
        (writer.partitionBy(*spec.partition_by) if spec.partition_by else writer).parquet(path)
    finally:
        spark.conf.unset(ADVISORY) if before is None else spark.conf.set(ADVISORY, before)
    made = Segment(first, last, _bytes(spark.read.schema(spec.log_schema).parquet(path)))
    listed = spark.createDataFrame([tuple(made)], SEGMENTS).coalesce(1)
    listed.write.mode("overwrite").parquet(f"{base}/segment_list/{table}/{first}-{last}")
    return made


def vacuum(spark: SparkSession, base: str, table: str = "expenses") -> int:
    """Delete commit folders and segments that a listed segment replaces; returns how many.

    Call it when no query planned before the compaction is running any more.
    """
    active = segments(spark, base, table)
    kept = {f"{s.first}-{s.last}" for s in active}
    last = active[-1].last if active else 0
    old = [p for p in files.matching(spark, f"{base}/log/{table}/commit_id=*") if int(p.rsplit("=", 1)[1]) <= last]
    listed = [p for p in files.matching(spark, f"{base}/segment_list/{table}/*") if p.rsplit("/", 1)[1] not in kept]
    data = [p for p in files.matching(spark, f"{base}/segments/{table}/segment=*") if p.rsplit("=", 1)[1] not in kept]
    for path in [*listed, *data, *old]:
        files.delete(spark, path)
    return len(old) + len(data)
