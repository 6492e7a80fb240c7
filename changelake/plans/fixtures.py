"""Change-log views derived from the given tables.

``orders`` plays the spending table: each order is one expense that is first
seen, perhaps corrected twice and perhaps deleted.  The order-entry tables are
text copies of the other tables with one follow-up change for some keys.  All
views are narrow projections of the Parquet scans; an expense's changes come
from exploding a small literal array, never from a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.schemas import AMOUNT, DELETE, INSERT, SNAPSHOT, UPDATE

def _key() -> Column:
    return F.col("k")


def _seq() -> Column:
    return F.col("seq")


# Column types of the given tables.  Naming them spares a job that
# would open files only to learn them.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def plus_days(start: Column, n: Column) -> Column:
    return start + F.make_dt_interval(n)


def _first_day() -> Column:
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


# -- expenses ----------------------------------------------------------------


def expense_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderdate").alias("d0"),
        F.col("o_totalprice").cast(AMOUNT).alias("amt0"),
        _text(F.col("o_orderkey")).alias("expense_id"),
        _text(F.col("o_custkey")).alias("user_id"),
        F.concat(F.lit("merchant-"), _text(F.col("o_custkey") % 40)).alias("merchant"),
        _text(F.col("o_orderdate").cast("date")).alias("expense_date"),
        F.col("o_orderpriority").alias("shopping_type"),
        F.col("o_orderstatus").alias("payment_method"),
        (F.col("o_orderkey") % 3 == 0).alias("recurring"),
    )


def _description(corrected: Column) -> Column:
    suffix = F.when(corrected, F.lit(" (corrected)")).otherwise(F.lit(""))
    return F.concat(F.col("shopping_type"), F.lit(" at "), F.col("merchant"), suffix)


def _amount(first: Column, second: Column) -> Column:
    plus = F.when(first, F.lit("2.50").cast(AMOUNT)).otherwise(F.lit("0").cast(AMOUNT))
    more = F.when(second, F.lit("5.00").cast(AMOUNT)).otherwise(F.lit("0").cast(AMOUNT))
    return (F.col("amt0") + plus + more).cast(AMOUNT)


def image_at(step: Column) -> list[Column]:
    """Columns of an expense row as it stood after change number ``step``."""
    first = (step >= 1) & (_key() % 4 == 0)
    second = (step >= 2) & (_key() % 8 == 0)
    return [
        F.col("expense_id"),
        F.col("user_id"),
        _description(first).alias("description"),
        F.col("merchant"),
        _amount(first, second).alias("expense_amount"),
        F.col("expense_date"),
        F.col("shopping_type"),
        F.col("payment_method"),
        F.col("recurring"),
    ]


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per change: the base columns and the change number ``seq``."""
    numbers = F.array(
        F.lit(0),
        F.when(_key() % 4 == 0, F.lit(1)),
        F.when(_key() % 8 == 0, F.lit(2)),
        F.when(_key() % 7 == 0, F.lit(3)),
    )
    return expense_base(spark, sf_dir).select("*", F.explode(numbers).alias("seq")).filter(_seq().isNotNull())


def operation() -> Column:
    return (
        F.when((_seq() == 0) & (_key() % 10 == 0), F.lit(SNAPSHOT))
        .when(_seq() == 0, F.lit(INSERT))
        .when(_seq() == 3, F.lit(DELETE))
        .otherwise(F.lit(UPDATE))
    )


def change_time() -> Column:
    return plus_days(F.col("d0"), _seq())


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expenses change log."""
    return changes(spark, sf_dir).select(
        *image_at(_seq()),
        F.lit("expenses").alias("cdc_table"),
        operation().alias("cdc_operation"),
        change_time().alias("cdc_ts"),
        (_seq() + 1).alias("commit_id"),
    )


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expenses table as it stands now."""
    return expense_base(spark, sf_dir).filter(_key() % 7 != 0).select(*image_at(F.lit(2)))


def first_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expenses table before any change, deletes not yet applied."""
    return expense_base(spark, sf_dir).select(*image_at(F.lit(0)))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two generations of the materialized snapshot."""
    gen = F.col("generation")
    stamped = expense_base(spark, sf_dir).filter(_key() % 5 != 0)
    return stamped.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("generation")).select(
        "expense_id",
        "merchant",
        "shopping_type",
        _amount((gen == 1) & (_key() % 4 == 0), F.lit(False)).alias("expense_amount"),
        F.concat(F.lit("2024-01-0"), _text(gen + 1), F.lit(" 00:00:00")).alias("snapshot_timestamp"),
    )


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per batch appended to the log."""
    per_commit = log(spark, sf_dir).groupBy("commit_id").agg(F.count(F.lit(1)).alias("added_rows"))
    return per_commit.select(
        "commit_id",
        F.when(F.col("commit_id") > 1, F.col("commit_id") - 1).alias("parent_id"),
        F.lit("append").alias("operation"),
        plus_days(_first_day(), F.col("commit_id") - 1).alias("committed_at"),
        F.create_map(F.lit("added_rows"), _text(F.col("added_rows"))).alias("summary"),
    )


# -- order-entry tables (all text) -------------------------------------------


def _two_steps(df: DataFrame, again: Column) -> DataFrame:
    """Each row once, and a second time where ``again`` holds."""
    steps = F.array(F.lit(0), F.when(again, F.lit(1)))
    return df.select("*", F.explode(steps).alias("seq")).filter(_seq().isNotNull())


def _insert_like(key: Column) -> Column:
    return F.when(_seq() == 1, F.lit(UPDATE)).when(key % 10 == 0, F.lit(SNAPSHOT)).otherwise(F.lit(INSERT))


def _snapshot_like() -> Column:
    return F.when(_seq() == 1, F.lit(UPDATE)).otherwise(F.lit(SNAPSHOT))


def _meta(name: str, op: Column, ts: Column) -> list[Column]:
    return [F.lit(name).alias("cdc_table"), op.alias("cdc_operation"), ts.alias("cdc_ts")]


def t_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    district = _text(key % 10 + 1)
    return _two_steps(table(spark, sf_dir, "orders"), key % 4 == 0).select(
        _text(key).alias("o_id"),
        district.alias("o_d_id"),
        F.lit("1").alias("o_w_id"),
        _text(F.col("o_custkey")).alias("o_c_id"),
        _text(key % 11 + 5).alias("o_ol_cnt"),
        F.when(_seq() == 1, district).otherwise(F.lit("")).alias("o_carrier_id"),
        *_meta("order", _insert_like(key), plus_days(F.col("o_orderdate"), _seq())),
    )


def t_order_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey")
    again = (key % 4 == 0) & (F.col("l_linenumber") == 1)
    return _two_steps(table(spark, sf_dir, "lineitem"), again).select(
        _text(key).alias("ol_o_id"),
        _text(F.col("l_suppkey") % 10 + 1).alias("ol_d_id"),
        _text(F.col("l_linenumber")).alias("ol_number"),
        _text(F.col("l_extendedprice").cast(AMOUNT)).alias("ol_amount"),
        *_meta("order_line", _insert_like(key), plus_days(F.col("l_shipdate"), _seq())),
    )


def t_new_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    pending = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "F")
    op = F.when(_seq() == 1, F.lit(DELETE)).otherwise(F.lit(INSERT))
    return _two_steps(pending, key % 3 != 0).select(
        _text(key).alias("no_o_id"),
        _text(key % 10 + 1).alias("no_d_id"),
        *_meta("new_order", op, plus_days(F.col("o_orderdate"), _seq())),
    )


def t_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    start = F.when(key % 50 == 0, F.lit(0.0)).otherwise(F.col("c_acctbal")).cast(AMOUNT)
    return _two_steps(table(spark, sf_dir, "customer"), key % 5 == 0).select(
        _text(key).alias("c_id"),
        _text(F.col("c_nationkey") % 10 + 1).alias("c_d_id"),
        F.lit("1").alias("c_w_id"),
        F.col("c_name").alias("c_last"),
        F.when(key % 10 == 0, F.lit("BC")).otherwise(F.lit("GC")).alias("c_credit"),
        _text(start + (_seq() * 100).cast(AMOUNT)).alias("c_balance"),
        _text(key % 37 + _seq()).alias("c_payment_cnt"),
        *_meta("customer", _snapshot_like(), plus_days(_first_day(), _seq())),
    )


def t_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return _two_steps(table(spark, sf_dir, "nation"), key % 2 == 0).select(
        _text(key).alias("d_id"),
        _text(F.col("n_regionkey")).alias("d_w_id"),
        F.col("n_name").alias("d_name"),
        _text(_seq() * 100 + 30000).alias("d_ytd"),
        *_meta("district", _snapshot_like(), plus_days(_first_day(), _seq())),
    )


def t_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        _text(F.col("r_regionkey")).alias("w_id"),
        F.col("r_name").alias("w_name"),
        *_meta("warehouse", F.lit(SNAPSHOT), _first_day()),
    )


def t_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return _two_steps(table(spark, sf_dir, "part"), key % 3 == 0).select(
        _text(key).alias("s_i_id"),
        F.lit("1").alias("s_w_id"),
        _text(F.col("p_size") + _seq()).alias("s_quantity"),
        _text(key % 53 + _seq()).alias("s_order_cnt"),
        _text(key % 7).alias("s_remote_cnt"),
        *_meta("stock", _snapshot_like(), plus_days(_first_day(), _seq())),
    )


def t_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "purchase")
        .select(
            _text(F.col("event_id")).alias("rowid"),
            _text(F.col("user_id")).alias("h_c_id"),
            _text(F.col("value").cast(AMOUNT)).alias("h_amount"),
            *_meta("history", F.lit(INSERT), F.col("ts")),
        )
    )


def t_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _text(F.col("p_partkey")).alias("i_id"),
        F.col("p_name").alias("i_name"),
        _text(F.col("p_retailprice").cast(AMOUNT)).alias("i_price"),
        *_meta("item", F.lit(SNAPSHOT), _first_day()),
    )


ORDER_ENTRY = {
    "order": t_order,
    "order_line": t_order_line,
    "new_order": t_new_order,
    "customer": t_customer,
    "district": t_district,
    "warehouse": t_warehouse,
    "stock": t_stock,
    "history": t_history,
    "item": t_item,
}


def order_entry(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: ORDER_ENTRY[n](spark, sf_dir) for n in (names or ORDER_ENTRY)}


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a few files or row groups over tasks, by their bytes, before JSON is made of them.

    A file's partitions may be without rows; made rows that all cores have already stay where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if not df.inputFiles() and df.rdd.getNumPartitions() >= cores else df.hint("rebalance")


def over_cores(df: DataFrame) -> DataFrame:
    """The same with a part per core, for rows that are cached: a cached plan keeps all its small parts."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
