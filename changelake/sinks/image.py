"""A table image that follows the log: bucketed by key, folded commit by commit.

The image is a catalog table with the newest change of each key, deletes included, so that a
change that arrives late meets what it has to give way to.  It is partitioned by ``slice`` (a
hash of the key) and, in each slice, bucketed and sorted by key.  A fold reduces the commits
since the last one to a row per key, reads only the slices these keys lie in, merges them by a
join on the buckets (only the changes are exchanged) and overwrites these slices alone.

The commit it stands at is a table property, set last.  A fold that dies is done again from
the old one, which changes nothing: the newest change of a key stays the newest.

Rows without a key belong to no image.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake import workdir
from changelake.operators.state import newest_images, operation_rank
from changelake.schemas import DELETE, REGISTRY
from changelake.sinks.snapshot import OVERWRITE_MODE
from changelake.sources.lake import COMMIT_ID, read_commits, read_log

SLICES = 64
BUCKETS = 16
ORDER = ("cdc_ts", "cdc_seq", "commit_id")
STANDS_AT = "changelake.commit_id"


def create_image(spark: SparkSession, name: str, table: str = "expenses", buckets: int = BUCKETS) -> None:
    """An image of no rows, at commit 0."""
    spec = REGISTRY[table]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*spec.log_schema.fields, COMMIT_ID])
    keys = ", ".join(f"`{k}`" for k in spec.keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, slice int) USING parquet PARTITIONED BY (slice) "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS TBLPROPERTIES ('{STANDS_AT}' = '0')"
    )


def stands_at(spark: SparkSession, name: str) -> int:
    return int(spark.sql(f"SHOW TBLPROPERTIES {name} ('{STANDS_AT}')").first()["value"])


def merged(image: DataFrame, changes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Per key the newer of the image's row and the change, by time, sequence and commit."""
    columns = image.columns
    # Both sides keep their key columns, so that the image's buckets serve the join.
    old = image.select(*[F.col(c).alias(f"old_{c}") for c in columns])
    new = changes.select(*[F.col(c).alias(f"new_{c}") for c in columns]).hint("merge")
    same = [F.col(f"old_{k}") == F.col(f"new_{k}") for k in keys]
    met = old.join(new, same, "full_outer")
    place = lambda side: F.struct(
        *[F.col(f"{side}_{c}").alias(c) for c in ORDER], operation_rank(F.col(f"{side}_cdc_operation")).alias("rank")
    )
    newer = F.col(f"old_{keys[0]}").isNull() | (F.col(f"new_{keys[0]}").isNotNull() & (place("new") >= place("old")))
    return met.select(*[F.when(newer, F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(c) for c in columns])


def fold_commits(spark: SparkSession, base: str, name: str, table: str = "expenses", to: int | None = None) -> list[int]:
    """Bring an image to commit ``to`` (the newest); returns the slices that were rewritten."""
    keys = REGISTRY[table].keys
    at = stands_at(spark, name)
    newest = read_commits(spark, base).agg(F.max("commit_id")).first()[0] or 0
    to = newest if to is None else min(to, newest)
    if to <= at:
        return []
    rows = read_log(spark, base, table).filter((F.col("commit_id") > at) & (F.col("commit_id") <= to)).dropna(subset=list(keys))
    changes = newest_images(rows, list(keys), list(ORDER)).withColumn("slice", F.pmod(F.xxhash64(*keys), F.lit(SLICES)).cast("int"))
    path = workdir.fresh(spark, "image-changes")
    changes.select(*spark.table(name).columns).write.parquet(path)
    changes = spark.read.parquet(path)
    touched = sorted(r["slice"] for r in changes.select("slice").distinct().collect())
    if touched:
        image = spark.table(name).filter(F.col("slice").isin(touched))
        before = spark.conf.get(OVERWRITE_MODE)
        spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            merged(image, changes, keys).write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set(OVERWRITE_MODE, before)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{STANDS_AT}' = '{to}')")
    return touched


def read_image(spark: SparkSession, name: str) -> DataFrame:
    """The rows that are live as of the commit the image stands at."""
    return spark.table(name).filter(F.col("cdc_operation") != DELETE).drop("slice")
