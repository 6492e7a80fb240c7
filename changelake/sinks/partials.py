"""Aggregates kept per commit, so that a report's cost follows the commits and not the rows.

Each commit of the expenses stores, per operation and key of a few report columns, mergeable
figures: counts, sum, least and greatest amount, first and last time.  Reports merge them.
They become visible with their commit, like its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.sized import top_k
from changelake.operators.reports import amount, excluding, shown
from changelake.schemas import DELETE
from changelake.sinks.log import append_side

GRAINS = ("shopping_type", "user_id", "merchant", "recurring")
COARSEST = "recurring"  # the grain with the fewest rows, for figures over all keys
FOLDER = "partials/expenses"


def partials(rows: DataFrame) -> DataFrame:
    """``grain, key, cdc_operation`` with the mergeable figures, all grains in one pass."""
    grain = F.coalesce(*[F.when(F.grouping(g) == 0, F.lit(g)) for g in GRAINS])
    key = F.coalesce(*[F.when(F.grouping(g) == 0, F.col(g).cast("string")) for g in GRAINS])
    grouped = rows.groupingSets([["cdc_operation", g] for g in GRAINS], "cdc_operation", *GRAINS).agg(
        grain.alias("grain"),
        key.alias("key"),
        F.count("*").alias("row_count"),
        F.count(amount()).alias("amount_count"),
        F.sum(amount()).alias("amount_sum"),
        F.min(amount()).alias("amount_min"),
        F.max(amount()).alias("amount_max"),
        F.min("cdc_ts").alias("first_ts"),
        F.max("cdc_ts").alias("last_ts"),
    )
    return grouped.drop(*GRAINS)


def write_partials(rows: DataFrame, base: str, commit_id: int) -> None:
    append_side(partials(rows), base, FOLDER, commit_id)


def merged(found: DataFrame, *keys: str) -> DataFrame:
    """Partial figures added up to coarser ones; merging again changes nothing."""
    return found.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"),
        F.sum("amount_count").alias("amount_count"),
        F.sum("amount_sum").cast("decimal(38,2)").alias("amount_sum"),
        F.min("amount_min").alias("amount_min"),
        F.max("amount_max").alias("amount_max"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    )


def _key(grain: str) -> Column:
    key = F.col("key")
    return (key.cast("boolean") if grain == "recurring" else key).alias(grain)


def spending_by(found: DataFrame, grain: str, exclude: tuple[str, ...] = (DELETE,), n: int | None = None) -> DataFrame:
    """As ``reports.spending_by`` over the log."""
    if grain not in GRAINS:
        raise ValueError(f"no partials by {grain}")
    picked = merged(excluding(found.filter(F.col("grain") == grain), exclude), "key")
    return top_k(picked.select(_key(grain), shown(F.col("amount_sum")).alias("total_spend"), F.col("row_count").alias("txn_count")), n, F.desc("total_spend"), F.col(grain))


def operation_totals(found: DataFrame) -> DataFrame:
    """As ``reports.operation_totals`` over the log."""
    picked = merged(found.filter(F.col("grain") == COARSEST), "cdc_operation")
    return picked.select("cdc_operation", F.col("row_count").alias("event_count"), shown(F.col("amount_sum")).alias("total_amount")).orderBy(F.desc("event_count"), "cdc_operation")


def amount_ranges(found: DataFrame, grain: str) -> DataFrame:
    """Least, greatest and mean amount and the time span per key, deletes excluded."""
    picked = merged(excluding(found.filter(F.col("grain") == grain), (DELETE,)), "key")
    return picked.select(
        _key(grain), shown(F.col("amount_min")).alias("amount_min"), shown(F.col("amount_max")).alias("amount_max"),
        F.try_divide(shown(F.col("amount_sum")), F.col("amount_count")).alias("amount_avg"), "first_ts", "last_ts",
    )
