"""Reports over the change log, the live table and the snapshot table.

Group-bys here run as partial and final hash aggregates, so a key that holds a
large part of the log shrinks to one row per task before it is shuffled.
Amounts are summed as DECIMAL and shown as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.sized import top_k
from changelake.schemas import DELETE, INSERT, UPDATE

def amount() -> Column:
    return F.col("expense_amount")


def shown(c: Column) -> Column:
    """An amount as reports show it."""
    return c.cast("double")


def total(c: Column | None = None) -> Column:
    return shown(F.sum(amount() if c is None else c))


def rows() -> Column:
    return F.count(F.lit(1))


def excluding(log: DataFrame, ops: tuple[str, ...]) -> DataFrame:
    """Rows whose operation is known and not one of ``ops``."""
    return log.filter(~F.col("cdc_operation").isin(*ops)) if ops else log


def all_changes(log: DataFrame) -> DataFrame:
    """Every change, newest first."""
    return log.select("expense_id", "merchant", shown(amount()).alias("expense_amount"), "cdc_operation", "cdc_ts").orderBy(
        F.desc("cdc_ts"), "expense_id", "cdc_operation"
    )


def audit_trail(log: DataFrame, key: str) -> DataFrame:
    """All changes of one expense, oldest first."""
    return (
        log.filter(F.col("expense_id") == key)
        .select(
            "expense_id",
            "description",
            shown(amount()).alias("expense_amount"),
            "payment_method",
            "cdc_operation",
            "cdc_ts",
        )
        .orderBy("cdc_ts")
    )


def operation_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("cdc_operation").agg(rows().alias("event_count"))


def operation_totals(log: DataFrame) -> DataFrame:
    return (
        log.groupBy("cdc_operation")
        .agg(rows().alias("event_count"), total().alias("total_amount"))
        .orderBy(F.desc("event_count"), "cdc_operation")
    )


def spending_by(df: DataFrame, key: str, exclude: tuple[str, ...] = (DELETE,), n: int | None = None) -> DataFrame:
    """Total amount and row count per key, largest total first."""
    grouped = excluding(df, exclude).groupBy(key).agg(total().alias("total_spend"), rows().alias("txn_count"))
    return top_k(grouped, n, F.desc("total_spend"), F.col(key))


def share_of_total(df: DataFrame, value: str, alias: str = "share_pct") -> DataFrame:
    """Add each row's percentage of the column total.

    The total is a one-row subquery; no row passes through a single task.  Shares of
    a zero total are null.
    """
    whole = df.agg(F.sum(value).alias("whole")).scalar()
    return df.withColumn(alias, F.try_divide(F.lit(100.0) * F.col(value).cast("double"), whole.cast("double")))


def category_share(log: DataFrame) -> DataFrame:
    """Share of spending per category, deletes excluded."""
    sums = excluding(log, (DELETE,)).groupBy(F.col("shopping_type").alias("category")).agg(F.sum(amount()).alias("total"))
    return share_of_total(sums, "total").withColumn("total", shown(F.col("total")))


def operation_share(log: DataFrame) -> DataFrame:
    """Share of events per operation."""
    return share_of_total(operation_counts(log).withColumnRenamed("cdc_operation", "operation"), "event_count")


def top_merchants(
    log: DataFrame, n: int | None = None, ops: tuple[str, ...] | None = (INSERT, UPDATE), exclude: tuple[str, ...] = ()
) -> DataFrame:
    """Merchants by spending with their average amount."""
    picked = excluding(log if ops is None else log.filter(F.col("cdc_operation").isin(*ops)), exclude)
    grouped = picked.groupBy("merchant").agg(
        total().alias("total_spend"), rows().alias("txn_count"), (total() / F.count(amount())).alias("avg_txn")
    )
    return top_k(grouped, n, F.desc("total_spend"), F.col("merchant"))


def totals(log: DataFrame) -> DataFrame:
    """Event count, spending without deletes, distinct expenses and merchants."""
    kept = F.when(F.col("cdc_operation") != DELETE, amount()).otherwise(F.lit(0).cast("decimal(12,2)"))
    return log.agg(
        rows().alias("total_events"),
        total(kept).alias("total_spend"),
        F.count_distinct("expense_id").alias("unique_expenses"),
        F.count_distinct("merchant").alias("unique_merchants"),
    )


def recent_changes(log: DataFrame, n: int = 20) -> DataFrame:
    picked = log.select(
        "expense_id", "merchant", shown(amount()).alias("expense_amount"), "cdc_operation", "cdc_ts", "shopping_type"
    )
    return top_k(picked, n, F.desc("cdc_ts"), F.col("expense_id"), F.col("cdc_operation"))


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    return df.agg(rows().alias(alias))


def category_summary(df: DataFrame) -> DataFrame:
    """Transactions and spending per category of a live or snapshot table."""
    return (
        df.groupBy("shopping_type")
        .agg(rows().alias("transactions"), total().alias("total_spend"))
        .orderBy(F.desc("total_spend"), "shopping_type")
    )


def live_summary(live: DataFrame) -> DataFrame:
    return live.agg(
        rows().alias("remaining_rows"),
        F.count_distinct("shopping_type").alias("categories"),
        F.count_distinct("merchant").alias("merchants"),
    ).select(F.lit("complete").alias("status"), "*")


def description_search(live: DataFrame, pattern: str) -> DataFrame:
    """Rows whose description matches a LIKE pattern, largest amount first."""
    return (
        live.filter(F.col("description").like(pattern))
        .select("expense_id", shown(amount()).alias("expense_amount"), "description")
        .orderBy(F.desc("expense_amount"), "expense_id")
    )


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows: a quick look at a table."""
    return df.limit(n)
