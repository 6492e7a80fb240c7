"""Reports over the order-entry change tables, whose columns are all text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.sized import top_k
from changelake.operators.reports import rows
from changelake.schemas import AMOUNT, INSERT, SNAPSHOT, UPDATE

FIRST_IMAGES = (INSERT, SNAPSHOT)
ALL_IMAGES = (INSERT, UPDATE, SNAPSHOT)


def having(df: DataFrame, ops: tuple[str, ...]) -> DataFrame:
    return df.filter(F.col("cdc_operation").isin(*ops))


def number(name: str) -> Column:
    """A text column as a whole number, NULL when it is not one."""
    return F.col(name).try_cast("bigint")


def money(name: str) -> Column:
    return F.col(name).try_cast(AMOUNT)


def event_overview(**tables: DataFrame) -> DataFrame:
    """Events per table and operation over any number of tables."""
    merged = reduce(DataFrame.unionByName, [t.select("cdc_table", "cdc_operation") for t in tables.values()])
    return (
        merged.groupBy("cdc_table", "cdc_operation")
        .agg(rows().alias("event_count"))
        .orderBy("cdc_table", F.desc("event_count"), "cdc_operation")
    )


def orders_per_district(orders: DataFrame) -> DataFrame:
    return (
        having(orders, FIRST_IMAGES)
        .groupBy(F.col("o_d_id").alias("district"))
        .agg(rows().alias("total_orders"))
        .orderBy(F.desc("total_orders"), "district")
    )


def revenue_by_district(lines: DataFrame, ops: tuple[str, ...] | None = FIRST_IMAGES) -> DataFrame:
    """Line items and revenue per district; ``ops=None`` for a live table."""
    picked = lines if ops is None else having(lines, ops)
    return (
        picked.groupBy(F.col("ol_d_id").alias("district"))
        .agg(rows().alias("line_items"), F.sum(money("ol_amount")).cast("double").alias("revenue"))
        .orderBy(F.desc("revenue"), "district")
    )


def avg_items(orders: DataFrame) -> DataFrame:
    return having(orders, FIRST_IMAGES).agg(
        F.round(F.avg(F.col("o_ol_cnt").try_cast("double")), 2).alias("avg_items_per_order"),
        rows().alias("total_orders"),
    )


def balance_buckets(customers: DataFrame) -> DataFrame:
    balance = money("c_balance")
    bucket = (
        F.when(balance < -100, F.lit("Owing > $100"))
        .when(balance < 0, F.lit("Owing < $100"))
        .when(balance == 0, F.lit("Zero Balance"))
        .otherwise(F.lit("Credit"))
    )
    return (
        having(customers, FIRST_IMAGES)
        .groupBy(bucket.alias("balance_bucket"))
        .agg(rows().alias("customer_count"))
        .orderBy(F.desc("customer_count"), "balance_bucket")
    )


def top_payers(customers: DataFrame, n: int = 10) -> DataFrame:
    names = [c for c in ("c_first", "c_last") if c in customers.columns]
    picked = having(customers, ALL_IMAGES).select("c_id", *names, "c_d_id", "c_payment_cnt", "c_balance")
    return top_k(picked, n, F.desc(number("c_payment_cnt")), F.col("c_id"), F.col("c_balance"))


def credit_types(customers: DataFrame) -> DataFrame:
    return having(customers, FIRST_IMAGES).groupBy("c_credit").agg(rows().alias("customer_count"))


def low_stock(stock: DataFrame, below: int = 15, n: int = 20, ops: tuple[str, ...] | None = ALL_IMAGES) -> DataFrame:
    """Stock rows under a quantity; ``ops=None`` looks at every change."""
    picked = (stock if ops is None else having(stock, ops)).filter(number("s_quantity") < below)
    return top_k(picked, n, number("s_quantity"), F.col("s_i_id"), F.col("s_order_cnt")).select(
        F.col("s_i_id").alias("item_id"),
        F.col("s_w_id").alias("warehouse"),
        F.col("s_quantity").alias("quantity"),
        F.col("s_order_cnt").alias("order_count"),
    )


def stock_turnover(stock: DataFrame, n: int = 10) -> DataFrame:
    picked = having(stock, ALL_IMAGES)
    return top_k(picked, n, F.desc(number("s_order_cnt")), F.col("s_i_id"), F.col("s_quantity")).select(
        F.col("s_i_id").alias("item_id"),
        F.col("s_order_cnt").alias("times_ordered"),
        F.col("s_quantity").alias("current_qty"),
        F.col("s_remote_cnt").alias("remote_orders"),
    )


def balance_changes(customers: DataFrame, n: int = 20, names: bool = False) -> DataFrame:
    extra = [c for c in ("c_first", "c_last") if names and c in customers.columns]
    picked = having(customers, (UPDATE,)).select("c_id", *extra, "c_balance", "cdc_operation", "cdc_ts")
    return top_k(picked, n, F.desc("cdc_ts"), F.col("c_id"))


def district_ytd(districts: DataFrame) -> DataFrame:
    return (
        having(districts, (UPDATE, SNAPSHOT))
        .select("d_id", "d_name", "d_ytd", "cdc_operation", "cdc_ts")
        .orderBy(F.desc("cdc_ts"), "d_id")
    )


def new_order_lifecycle(new_orders: DataFrame, n: int = 20) -> DataFrame:
    picked = new_orders.select("no_o_id", "no_d_id", "cdc_operation", "cdc_ts")
    return top_k(picked, n, F.col("no_o_id"), F.col("cdc_ts"))


def customer_history(live_customers: DataFrame, customers: DataFrame, n: int = 20) -> DataFrame:
    """Live balance next to earlier balances, joined on the composite key."""
    keys = ["c_id", "c_d_id", "c_w_id"]
    names = [c for c in ("c_first", "c_last") if c in live_customers.columns]
    now = live_customers.select(*keys, *names, money("c_balance").cast("double").alias("current_balance"))
    then = having(customers, (UPDATE,)).select(
        *keys, money("c_balance").cast("double").alias("historical_balance"), "cdc_operation", "cdc_ts"
    )
    picked = now.join(then, keys).select(
        "c_id", *names, "current_balance", "historical_balance", "cdc_operation", "cdc_ts"
    )
    return top_k(picked, n, F.desc("cdc_ts"), F.col("c_id"))
