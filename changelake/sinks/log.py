"""The change log: one folder per commit, so writing a commit again replaces it."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake import files
from changelake.operators.shaping import all_strings
from changelake.schemas import REGISTRY
from changelake.sources.lake import COMMITS, OTHER, OTHER_TYPES, archive_path, escaped

SIDES = ("progress", "dead", "intake", f"log/{OTHER}", OTHER_TYPES, "partials/expenses", "released")
BLOOM_BYTES = 1 << 20


def key_filters(keys: tuple[str, ...]) -> dict[str, str]:
    """Parquet options for Bloom filters on the keys, each as large as its row group needs up to 1 MB."""
    sized = {"parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.max.bytes": str(BLOOM_BYTES)}
    return {**sized, **{f"parquet.bloom.filter.enabled#{k}": "true" for k in keys}} if keys else {}


# Parts that each folder's rows are dealt over; few rows are put together again by their bytes.
PARTS = 64


def rebalanced(df: DataFrame, partition_by: tuple[str, ...] = (), keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows in tasks of about the advisory size, also where one folder gets most rows of one large input task.

    A task's rows of one folder are never split again, so they are dealt over parts by their keys beforehand.
    """
    if not partition_by:
        return df.hint("rebalance")
    part = F.pmod(F.xxhash64(*(keys or df.columns)), F.lit(PARTS))
    return df.withColumn("_part", part).hint("rebalance", *partition_by, "_part").drop("_part")


def _write(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), keys: tuple[str, ...] = ()) -> None:
    out = rebalanced(df, partition_by, keys)
    if keys:
        out = out.sortWithinPartitions(*partition_by, *keys)
    writer = out.write.mode("overwrite").option("compression", "snappy").options(**key_filters(keys))
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_log(df: DataFrame, base: str, table: str, commit_id: int) -> None:
    """Write one commit's rows of one registered table, sorted by key so that a key lookup skips most pages."""
    spec = REGISTRY[table]
    rows = df.select(*spec.log_schema.fieldNames()).withColumns({c: escaped(F.col(c)) for c in spec.partition_by})
    _write(rows, f"{base}/log/{table}/commit_id={commit_id}", spec.partition_by, spec.keys)


def append_side(df: DataFrame, base: str, name: str, commit_id: int) -> None:
    """Write one commit's rows of a side table (progress, dead letters, other rows)."""
    _write(df, f"{base}/{name}/commit_id={commit_id}")


def clear_commit(spark: SparkSession, base: str, commit_id: int, archive: str | None = None) -> None:
    """Delete what an attempt that was never listed left under this number, in every table.

    The next attempt may have other tables, and other days in the archive.
    """
    for name in (*(f"log/{t}" for t in REGISTRY), *SIDES):
        files.delete(spark, f"{base}/{name}/commit_id={commit_id}")
    for table in (*REGISTRY, OTHER) if archive else ():
        lead = "cdc_table=*/" if table == OTHER else ""
        for path in files.matching(spark, f"{archive_path(archive, table)}/{lead}year=*/month=*/day=*/commit_id={commit_id}"):
            files.delete(spark, path)


def write_commit(
    spark: SparkSession,
    base: str,
    commit_id: int,
    summary: dict[str, int],
    operation: str = "append",
    at: datetime | None = None,
    writer: str | None = None,
) -> None:
    """List a commit and the query that wrote it; its rows become visible with this one-row write."""
    row = (
        commit_id,
        commit_id - 1 if commit_id > 1 else None,
        operation,
        at or datetime.now(timezone.utc),
        {k: str(v) for k, v in sorted(summary.items())},
        writer,
    )
    df = spark.createDataFrame([row], COMMITS).drop("commit_id").coalesce(1)
    df.write.mode("overwrite").parquet(f"{base}/commits/commit_id={commit_id}")


def append_table(df: DataFrame, table: str) -> None:
    """Append to a catalog table by column name, as text where the table is all text."""
    target = df.sparkSession.table(table)
    if all(t == "string" for _, t in target.dtypes):
        df = all_strings(df)
    df.select(*target.columns).write.mode("append").insertInto(table)
