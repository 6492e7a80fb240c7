"""Reports over the order-entry tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelake.operators import hybrid as H
from changelake.operators import order_entry as E
from changelake.plans import fixtures as X
from changelake.plans.catalogue import Catalogue
from changelake.plans.oracle_views import order_entry as sql

OVERVIEW = ("order", "order_line", "new_order", "customer", "district", "warehouse", "stock", "history")
OVERVIEW_BRIEF = ("order", "order_line", "customer", "stock")
FIRST = "cdc_operation IN ('insert', 'snapshot')"
IMAGES = "cdc_operation IN ('insert', 'update', 'snapshot')"


def live_side(df):
    """The live table behind a change table: its rows as first captured."""
    return E.having(df, E.FIRST_IMAGES)


def union_of(names) -> str:
    return " UNION ALL ".join(f"SELECT cdc_table, cdc_operation FROM t_{n}" for n in names)


def register(c: Catalogue) -> None:
    for name, tables in (("tpcc_event_overview", OVERVIEW), ("tpcc_event_overview_brief", OVERVIEW_BRIEF)):
        c.add(
            name,
            lambda s, d, tables=tables: E.event_overview(**X.order_entry(s, d, *tables)),
            sql(f"SELECT cdc_table, cdc_operation, COUNT(*) AS event_count FROM ({union_of(tables)}) u GROUP BY cdc_table, cdc_operation"),
        )
    c.add(
        "tpcc_orders_per_district",
        lambda s, d: E.orders_per_district(X.t_order(s, d)),
        sql(f"SELECT o_d_id AS district, COUNT(*) AS total_orders FROM t_order WHERE {FIRST} GROUP BY o_d_id"),
    )
    revenue = f"SELECT ol_d_id AS district, COUNT(*) AS line_items, CAST(SUM(CAST(ol_amount AS DECIMAL(12,2))) AS DOUBLE) AS revenue FROM t_order_line WHERE {FIRST} GROUP BY ol_d_id"
    c.add("tpcc_revenue_by_district", lambda s, d: E.revenue_by_district(X.t_order_line(s, d)), sql(revenue))
    c.add(
        "tpcc_live_revenue_by_district",
        lambda s, d: E.revenue_by_district(live_side(X.t_order_line(s, d)), ops=None),
        sql(revenue),
    )
    c.add(
        "tpcc_avg_items",
        lambda s, d: E.avg_items(X.t_order(s, d)),
        sql(f"SELECT ROUND(AVG(CAST(o_ol_cnt AS DOUBLE)), 2) AS avg_items_per_order, COUNT(*) AS total_orders FROM t_order WHERE {FIRST}"),
    )
    c.add(
        "tpcc_balance_buckets",
        lambda s, d: E.balance_buckets(X.t_customer(s, d)),
        sql(f"""SELECT CASE WHEN CAST(c_balance AS DECIMAL(12,2)) < -100 THEN 'Owing > $100' WHEN CAST(c_balance AS DECIMAL(12,2)) < 0 THEN 'Owing < $100'
WHEN CAST(c_balance AS DECIMAL(12,2)) = 0 THEN 'Zero Balance' ELSE 'Credit' END AS balance_bucket, COUNT(*) AS customer_count
FROM t_customer WHERE {FIRST} GROUP BY 1"""),
    )
    c.add(
        "tpcc_top_payers",
        lambda s, d: E.top_payers(X.t_customer(s, d)),
        sql(f"""SELECT c_id, c_last, c_d_id, c_payment_cnt, c_balance FROM t_customer WHERE {IMAGES}
ORDER BY CAST(c_payment_cnt AS BIGINT) DESC, c_id, c_balance LIMIT 10"""),
    )
    c.add(
        "tpcc_credit_types",
        lambda s, d: E.credit_types(X.t_customer(s, d)),
        sql(f"SELECT c_credit, COUNT(*) AS customer_count FROM t_customer WHERE {FIRST} GROUP BY c_credit"),
    )
    for name, ops, where in (("tpcc_low_stock", E.ALL_IMAGES, f"{IMAGES} AND "), ("tpcc_low_stock_all_changes", None, "")):
        c.add(
            name,
            lambda s, d, ops=ops: E.low_stock(X.t_stock(s, d), ops=ops),
            sql(f"""SELECT s_i_id AS item_id, s_w_id AS warehouse, s_quantity AS quantity, s_order_cnt AS order_count FROM t_stock
WHERE {where}CAST(s_quantity AS BIGINT) < 15 ORDER BY CAST(s_quantity AS BIGINT), s_i_id, s_order_cnt LIMIT 20"""),
        )
    c.add(
        "tpcc_stock_turnover",
        lambda s, d: E.stock_turnover(X.t_stock(s, d)),
        sql(f"""SELECT s_i_id AS item_id, s_order_cnt AS times_ordered, s_quantity AS current_qty, s_remote_cnt AS remote_orders FROM t_stock
WHERE {IMAGES} ORDER BY CAST(s_order_cnt AS BIGINT) DESC, s_i_id, s_quantity LIMIT 10"""),
    )
    c.add(
        "tpcc_balance_changes",
        lambda s, d: E.balance_changes(X.t_customer(s, d)),
        sql("SELECT c_id, c_balance, cdc_operation, cdc_ts FROM t_customer WHERE cdc_operation = 'update' ORDER BY cdc_ts DESC, c_id LIMIT 20"),
    )
    c.add(
        "tpcc_balance_changes_named",
        lambda s, d: E.balance_changes(X.t_customer(s, d), n=10, names=True),
        sql("SELECT c_id, c_last, c_balance, cdc_operation, cdc_ts FROM t_customer WHERE cdc_operation = 'update' ORDER BY cdc_ts DESC, c_id LIMIT 10"),
    )
    c.add(
        "tpcc_district_ytd",
        lambda s, d: E.district_ytd(X.t_district(s, d)),
        sql("SELECT d_id, d_name, d_ytd, cdc_operation, cdc_ts FROM t_district WHERE cdc_operation IN ('update', 'snapshot') ORDER BY cdc_ts DESC"),
    )
    c.add(
        "tpcc_new_order_lifecycle",
        lambda s, d: E.new_order_lifecycle(X.t_new_order(s, d)),
        sql("SELECT no_o_id, no_d_id, cdc_operation, cdc_ts FROM t_new_order ORDER BY no_o_id, cdc_ts LIMIT 20"),
    )
    c.add(
        "tpcc_live_vs_log_counts",
        lambda s, d: H.source_counts(live=live_side(X.t_order(s, d)), change_log=X.t_order(s, d)),
        sql(f"SELECT 'live' AS source, COUNT(*) AS total_rows FROM t_order WHERE {FIRST} UNION ALL SELECT 'change_log', COUNT(*) FROM t_order"),
    )
    c.add(
        "tpcc_customer_history_join",
        lambda s, d: E.customer_history(X.t_customer(s, d).filter(F.col("cdc_operation") == "snapshot"), X.t_customer(s, d)),
        sql("""SELECT l.c_id, l.c_last, CAST(CAST(l.c_balance AS DECIMAL(12,2)) AS DOUBLE) AS current_balance,
CAST(CAST(c.c_balance AS DECIMAL(12,2)) AS DOUBLE) AS historical_balance, c.cdc_operation, c.cdc_ts
FROM t_customer l JOIN t_customer c ON l.c_id = c.c_id AND l.c_d_id = c.c_d_id AND l.c_w_id = c.c_w_id
WHERE l.cdc_operation = 'snapshot' AND c.cdc_operation = 'update' ORDER BY c.cdc_ts DESC, l.c_id LIMIT 20"""),
    )
