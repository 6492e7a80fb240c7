"""Tables the library wrote: the change log, its commits, the archive."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.operators.shaping import typed_by
from changelake.schemas import REGISTRY

OTHER = "_other"  # rows of tables nobody registered

COMMIT_ID = T.StructField("commit_id", T.LongType())

COMMITS = T.StructType(
    [
        COMMIT_ID,
        T.StructField("parent_id", T.LongType()),
        T.StructField("operation", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("summary", T.MapType(T.StringType(), T.StringType())),
        T.StructField("writer", T.StringType()),
    ]
)

MARKERS = T.StructType(
    [T.StructField("feed", T.StringType()), T.StructField("resolved", T.StringType()), T.StructField("resolved_ts", T.TimestampType()), COMMIT_ID]
)

DEAD_LETTERS = T.StructType(
    [T.StructField("feed", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("body", T.StringType()), COMMIT_ID]
)

INTAKE = T.StructType([T.StructField("source", T.StringType()), T.StructField("position", T.LongType()), COMMIT_ID])

OTHER_ROWS = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("cdc_table", T.StringType()),
        T.StructField("cdc_operation", T.StringType()),
        T.StructField("cdc_timestamp", T.StringType()),
        T.StructField("cdc_ts", T.TimestampType()),
        T.StructField("cdc_seq", T.LongType()),
        T.StructField("body", T.StringType()),
        COMMIT_ID,
    ]
)


# In the log the image is a VARIANT; commits of earlier versions hold its text in ``body`` instead.
OTHER_STORED = T.StructType([*OTHER_ROWS.fields[:-1], T.StructField("row", T.VariantType()), COMMIT_ID])

OTHER_TYPES = "types/_other"

_TARGET, _STAGE_ID = T.StructField("target", T.StringType()), T.StructField("stage_id", T.LongType())

STAGES = T.StructType([_TARGET, T.StructField("rows", T.LongType()), T.StructField("staged_at", T.TimestampType()), T.StructField("writer", T.StringType()), _STAGE_ID])

RELEASED = T.StructType([_TARGET, _STAGE_ID, COMMIT_ID])

MEMBER_TYPES = T.StructType([*[T.StructField(c, T.StringType()) for c in ("cdc_table", "name", "type")], COMMIT_ID])


def _parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet folder, or no rows while nothing was written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_commits(spark: SparkSession, base: str) -> DataFrame:
    return _parquet(spark, f"{base}/commits", COMMITS)


def escaped(folder: Column) -> Column:
    """A text as a folder name that can be empty: a folder without a name is read as NULL."""
    return F.when((folder == "") | folder.startswith("="), F.concat(F.lit("="), folder)).otherwise(folder)


def _unescaped(folder: Column) -> Column:
    return F.regexp_replace(folder, "^=", "")


def _committed(df: DataFrame, spark: SparkSession, base: str) -> DataFrame:
    """Rows of finished commits.

    Commits follow one another, so only a commit newer than the newest listed
    one can be unfinished.  The bound is a one-row subquery on a partition
    column: folders of an unfinished commit are not opened.
    """
    newest = read_commits(spark, base).agg(F.max("commit_id").alias("newest")).scalar()
    return df.filter(F.col("commit_id") <= newest)


class Segment(NamedTuple):
    """Commits ``first`` to ``last`` in few large files."""

    first: int
    last: int
    bytes: int


SEGMENTS = T.StructType([T.StructField(f, T.LongType()) for f in Segment._fields])


def segment_path(base: str, table: str, first: int, last: int) -> str:
    return f"{base}/segments/{table}/segment={first}-{last}"


def segments(spark: SparkSession, base: str, table: str) -> list[Segment]:
    """The listed segments that no larger one replaces, in order; few, as compaction joins them by tiers."""
    listed = [Segment(*r) for r in _parquet(spark, f"{base}/segment_list/{table}/*", SEGMENTS).collect()]
    return sorted(s for s in listed if not any(o != s and o.first <= s.first and s.last <= o.last for o in listed))


def log_fields(table: str) -> T.StructType:
    return T.StructType([*REGISTRY[table].log_schema.fields, COMMIT_ID])


def log_part(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The commit folders of one registered table that are still there, committed or not."""
    return _parquet(spark, f"{base}/log/{table}", log_fields(table))


def read_log(spark: SparkSession, base: str, table: str = "expenses", with_files: bool = False) -> DataFrame:
    """The committed change log of one registered table.

    Compacted commits are read from their segments, the rest from their folders.
    ``with_files`` adds each row's ``file_path`` and ``file_bytes``.
    """
    found = segments(spark, base, table)
    rows = _committed(log_part(spark, base, table), spark, base)
    parts = [rows.filter(F.col("commit_id") > found[-1].last) if found else rows]
    if found:
        paths = [segment_path(base, table, s.first, s.last) for s in found]
        parts.append(spark.read.schema(log_fields(table)).option("basePath", f"{base}/segments/{table}").parquet(*paths))
    more = {"file_path": F.col("_metadata.file_path"), "file_bytes": F.col("_metadata.file_size")} if with_files else {}
    parts = [p.select(*log_fields(table).fieldNames(), *[c.alias(n) for n, c in more.items()]) for p in parts]
    log = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return log.withColumns({c: _unescaped(F.col(c)) for c in REGISTRY[table].partition_by})


def read_partials(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """Committed aggregates of the expenses."""
    return _committed(_parquet(spark, f"{base}/partials/expenses", T.StructType([*schema.fields, COMMIT_ID])), spark, base)


def register_log(spark: SparkSession, base: str, prefix: str = "") -> list[str]:
    """The committed log of every registered table, and its commits, as views of the session.

    Register again to see commits that were written meanwhile.
    """
    for table in REGISTRY:
        read_log(spark, base, table).createOrReplaceTempView(prefix + table)
    read_commits(spark, base).createOrReplaceTempView(f"{prefix}commits")
    return [*(prefix + t for t in REGISTRY), f"{prefix}commits"]


def _other_rows(spark: SparkSession, base: str) -> DataFrame:
    return _committed(_parquet(spark, f"{base}/log/{OTHER}", OTHER_STORED), spark, base)


def read_other_rows(spark: SparkSession, base: str) -> DataFrame:
    """Committed rows of tables nobody registered, as JSON text."""
    return _other_rows(spark, base).withColumn("body", F.coalesce("body", F.to_json("row"))).select(*OTHER_ROWS.fieldNames())


def read_member_types(spark: SparkSession, base: str) -> DataFrame:
    """What each commit found in the members of unregistered tables."""
    return _committed(_parquet(spark, f"{base}/{OTHER_TYPES}", MEMBER_TYPES), spark, base)


def read_typed_rows(spark: SparkSession, base: str, table: str, as_of: int | None = None) -> DataFrame:
    """Committed rows of a table nobody registered, with a typed column per member.

    Types are merged from what each commit kept, so no row is looked at for them; a
    member that a commit lacks takes its default there.  ``as_of`` stops at a commit, for
    rows and types alike.  Commits written before types were kept are not typed: their rows
    are left to ``read_other_rows``, and asking for them here is an error.
    """
    upto = F.lit(True) if as_of is None else F.col("commit_id") <= as_of
    rows = _other_rows(spark, base).filter((F.col("cdc_table") == table) & upto)
    if not rows.filter(F.col("row").isNull()).isEmpty():
        raise ValueError(f"{table} has rows from before types were kept")
    types = read_member_types(spark, base).filter((F.col("cdc_table") == table) & upto)
    return typed_by(rows.select("row", "cdc_table", "cdc_operation", "cdc_timestamp", "cdc_ts", "cdc_seq", "commit_id"), types)


def read_progress(spark: SparkSession, base: str) -> DataFrame:
    return _committed(_parquet(spark, f"{base}/progress", MARKERS), spark, base)


def read_intake(spark: SparkSession, base: str) -> DataFrame:
    """What committed batches took in: files, or topic partitions with the last offset."""
    return _committed(_parquet(spark, f"{base}/intake", INTAKE), spark, base)


def read_stages(spark: SparkSession, base: str) -> DataFrame:
    """What listed stages hold: events per target, and since when."""
    return _parquet(spark, f"{base}/staging/list", STAGES)


def read_released(spark: SparkSession, base: str) -> DataFrame:
    """Up to which stage committed releases took each target."""
    return _committed(_parquet(spark, f"{base}/released", RELEASED), spark, base)


def read_dead_letters(spark: SparkSession, base: str) -> DataFrame:
    return _committed(_parquet(spark, f"{base}/dead", DEAD_LETTERS), spark, base)


def archive_path(base: str, table: str) -> str:
    return f"{base}/unregistered" if table == OTHER else f"{base}/{REGISTRY[table].namespace}/{table}"


def read_archive(spark: SparkSession, base: str, table: str = "expenses", log: str | None = None) -> DataFrame:
    """The dated archive; filters on year, month and day skip whole folders.

    ``table`` ``_other`` holds the rows of all unregistered tables.  With the base
    folder of the ``log`` it is filed beside, only committed rows are read.
    """
    own = OTHER_ROWS.fields[:-1] if table == OTHER else REGISTRY[table].log_schema.fields
    parts = [T.StructField(c, T.StringType()) for c in ("year", "month", "day")]
    rows = _parquet(spark, archive_path(base, table), T.StructType([*own, *parts, COMMIT_ID]))
    return (rows if log is None else _committed(rows, spark, log)).drop("commit_id")
