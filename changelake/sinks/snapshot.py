"""Snapshots of the live table as catalog tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.schemas import REGISTRY

PARTITION = "shopping_type"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
LOG_VERSION = "changelake.log_version"


def snapshot_rows(live: DataFrame, stamp: Column | str | None = None) -> DataFrame:
    """The live rows in their registered types with a snapshot time."""
    when = F.current_timestamp().cast("string") if stamp is None else (F.lit(stamp) if isinstance(stamp, str) else stamp)
    fields = REGISTRY["expenses"].columns.fields
    return live.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields], when.alias("snapshot_timestamp")
    )


def materialize_snapshot(
    live: DataFrame, table: str, stamp: Column | str | None = None, mode: str = "overwrite", path: str | None = None
) -> DataFrame:
    """Write a snapshot table and return it.

    ``overwrite`` refreshes the table, ``append`` adds a generation.
    """
    rows = snapshot_rows(live, stamp).hint("rebalance", PARTITION)
    writer = rows.write.format("parquet").mode(mode).partitionBy(PARTITION)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
    return live.sparkSession.table(table)


def refresh_categories(live: DataFrame, table: str, stamp: Column | str | None = None) -> DataFrame:
    """Replace only the categories present in ``live``; other partitions stay."""
    spark = live.sparkSession
    rows = snapshot_rows(live, stamp).select(*spark.table(table).columns).hint("rebalance", PARTITION)
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)
    return spark.table(table)


def mark_version(spark: SparkSession, table: str, commit_id: int) -> None:
    """Remember that a snapshot table holds the live table as of a commit of the log."""
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LOG_VERSION}' = '{commit_id}')")


def marked_version(spark: SparkSession, table: str) -> int | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == LOG_VERSION).first()
    return int(found["value"]) if found else None


def changed_categories(log: DataFrame, snapshot: DataFrame, after: int, to: int) -> list[str | None]:
    """Categories that commits ``after`` + 1 to ``to`` touch: those of the changes' images, and those where the snapshot has their keys.

    The list is one value per category, as many as the snapshot has folders.  An empty
    category is the null one, which is how a partition folder keeps it.
    """
    key, category = REGISTRY["expenses"].keys[0], F.nullif(F.col(PARTITION), F.lit("")).alias(PARTITION)
    changes = log.filter((F.col("commit_id") > after) & (F.col("commit_id") <= to)).select(key, category)
    moved = snapshot.select(key, category).join(changes.select(key).distinct(), key, "left_semi")
    return [r[0] for r in changes.select(PARTITION).union(moved.select(PARTITION)).distinct().collect()]


def refresh_by_log(live: DataFrame, log: DataFrame, table: str, to: int, stamp: Column | str | None = None) -> list[str | None]:
    """Bring a snapshot to commit ``to`` of the log, rewriting only the categories that changed since; returns them.

    ``live`` is the table as of ``to``; a later one is fine as well, since its later changes
    are taken again by the next refresh.  Partitions that lost all rows are dropped.  The
    version is remembered last, so a refresh that dies is simply done again.  A snapshot
    without a version has to be made by ``materialize_snapshot`` and ``mark_version`` first.
    """
    spark = live.sparkSession
    after = marked_version(spark, table)
    if after is None:
        raise ValueError(f"{table} does not say which commit it stands at")
    touched = changed_categories(log, spark.table(table), after, to) if to > after else []
    if touched:
        category = F.nullif(F.col(PARTITION), F.lit(""))
        chosen = category.isin(*[c for c in touched if c is not None])
        fresh = live.filter(chosen | category.isNull() if None in touched else chosen)
        left = {r[0] for r in fresh.select(category).distinct().collect()}
        refresh_categories(fresh, table, stamp)
        for gone in (c for c in touched if c not in left):
            value = "NULL" if gone is None else "'" + gone.replace("\\", "\\\\").replace("'", "\\'") + "'"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{PARTITION}` = {value})")
    if to > after:
        mark_version(spark, table, to)
    return touched
