"""Questions that combine the live table, the change log and the snapshots.

``expense_id`` is the primary key of the live table and unique within one
snapshot generation.  That makes two plan shapes exact: the log is reduced to
one row per key before it meets the live table, and a top-k that depends only
on the log is taken before the other tables are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.functions.sized import top_k
from changelake.operators.reports import amount, rows, shown, total
from changelake.schemas import DELETE, INSERT, SNAPSHOT, UPDATE

KEY = "expense_id"


def source_counts(**sources: DataFrame) -> DataFrame:
    """Row count of each named table."""
    parts = [df.agg(rows().alias("total_rows")).select(F.lit(n).alias("source"), "*") for n, df in sources.items()]
    return reduce(DataFrame.unionByName, parts)


def compare_sources(**sources: DataFrame) -> DataFrame:
    """Row count, spending and distinct merchants of each named table."""
    parts = [
        df.agg(
            rows().alias("total_rows"), total().alias("total_spend"), F.count_distinct("merchant").alias("merchants")
        ).select(F.lit(name).alias("source"), "*")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def live_with_history(live: DataFrame, log: DataFrame, n: int = 20) -> DataFrame:
    """Newest changes next to the live row they belong to."""
    now = live.select(KEY, "merchant", amount().alias("_now"), "shopping_type")
    then = log.select(KEY, amount().alias("_then"), "cdc_operation", "cdc_ts")
    joined = now.join(then, KEY).select(
        KEY,
        "merchant",
        shown(F.col("_now")).alias("current_amount"),
        "shopping_type",
        shown(F.col("_then")).alias("historical_amount"),
        "cdc_operation",
        "cdc_ts",
    )
    return top_k(joined, n, F.desc("cdc_ts"), F.col(KEY), F.col("cdc_operation"))


def changed_amounts(live: DataFrame, log: DataFrame, n: int = 10) -> DataFrame:
    """Update images that differ most from the live amount."""
    now = live.select(KEY, "merchant", amount().alias("_now"))
    then = log.filter(F.col("cdc_operation") == UPDATE).select(KEY, amount().alias("_then"), "cdc_operation", "cdc_ts")
    diff = F.col("_now") - F.col("_then")
    joined = now.join(then, KEY).withColumn("_diff", diff)
    return top_k(joined, n, F.desc(F.abs(F.col("_diff"))), F.col(KEY), F.col("cdc_ts")).select(
        KEY,
        "merchant",
        shown(F.col("_now")).alias("current_amount"),
        shown(F.col("_then")).alias("previous_amount"),
        shown(F.round("_diff", 2)).alias("difference"),
        "cdc_operation",
        "cdc_ts",
    )


def ghost_records(log: DataFrame, live: DataFrame) -> DataFrame:
    """Deleted expenses the log still remembers."""
    gone = log.filter(F.col("cdc_operation") == DELETE).select(
        KEY, "merchant", shown(amount()).alias("expense_amount"), "shopping_type", F.col("cdc_ts").alias("deleted_at")
    )
    return gone.join(live.select(KEY), KEY, "left_anti").orderBy(F.desc("deleted_at"), KEY)


def modification_audit(live: DataFrame, log: DataFrame, n: int = 20) -> DataFrame:
    """Live expenses with more than one change, most changed first."""
    is_update = F.when(F.col("cdc_operation") == UPDATE, F.lit(1)).otherwise(F.lit(0))
    per_key = (
        log.groupBy(KEY)
        .agg(
            F.count("cdc_operation").alias("total_changes"),
            F.sum(is_update).alias("updates"),
            F.min("cdc_ts").alias("first_seen"),
            F.max("cdc_ts").alias("last_changed"),
        )
        .filter(F.col("total_changes") > 1)
    )
    joined = live.select(KEY, "merchant", shown(amount()).alias("current_amount")).join(per_key, KEY)
    return top_k(joined, n, F.desc("total_changes"), F.col(KEY))


def latest_generation(snap: DataFrame) -> DataFrame:
    """Rows of the newest snapshot generation."""
    newest = snap.agg(F.max("snapshot_timestamp").alias("newest")).scalar()
    return snap.filter(F.col("snapshot_timestamp") == newest)


def full_lifecycle(log: DataFrame, live: DataFrame, snap: DataFrame, n: int = 20) -> DataFrame:
    """Status, amounts and change counts of the most changed expenses.

    The order depends on the log alone, so the ``n`` rows are taken first.  They
    travel as one subquery value that is computed once and used three times: as
    the rows to complete and as the keys that the live and snapshot rows must have.
    """
    per_key = log.groupBy(KEY, "merchant").agg(
        F.count("cdc_operation").alias("total_cdc_events"),
        F.min("cdc_ts").alias("first_seen"),
        F.max("cdc_ts").alias("last_changed"),
    )
    picked = top_k(per_key, n, F.desc("total_cdc_events"), F.col(KEY), F.col("merchant"))
    now = live.select(KEY, F.col("merchant").alias("_merchant"), shown(amount()).alias("live_amount"), F.lit(True).alias("_live"))
    then = latest_generation(snap).select(KEY, shown(amount()).alias("snapshot_amount"))
    found = picked.agg(F.collect_list(F.struct(*picked.columns)).alias("rows")).scalar()
    picked = log.sparkSession.range(1).select(F.inline(found))
    now, then = (df.join(picked.select(KEY), KEY, "left_semi") for df in (now, then))
    return (
        picked.join(now, KEY, "left")
        .join(then, KEY, "left")
        .select(
            KEY,
            F.when(F.col("_live"), F.lit("Active")).otherwise(F.lit("Deleted")).alias("status"),
            F.coalesce("_merchant", "merchant").alias("merchant"),
            "live_amount",
            "snapshot_amount",
            "total_cdc_events",
            "first_seen",
            "last_changed",
        )
    )


def price_drift(live: DataFrame, log: DataFrame, n: int = 10, first_seen: bool = False) -> DataFrame:
    """Live amounts that moved away from the first image.

    First images are inserts; ``first_seen`` also counts initial-scan images.
    """
    first_ops = (INSERT, SNAPSHOT) if first_seen else (INSERT,)
    original = log.filter(F.col("cdc_operation").isin(*first_ops)).select(KEY, amount().alias("_first"))
    joined = (
        live.select(KEY, "merchant", amount().alias("_now"))
        .join(original, KEY)
        .filter(F.col("_now") != F.col("_first"))
        .withColumn("_change", F.col("_now") - F.col("_first"))
    )
    return top_k(joined, n, F.desc(F.abs(F.col("_change"))), F.col(KEY), F.col("_first")).select(
        KEY,
        "merchant",
        shown(F.col("_now")).alias("current_amount"),
        shown(F.col("_first")).alias("original_amount"),
        shown(F.round("_change", 2)).alias("price_change"),
    )
