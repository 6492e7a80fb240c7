"""The fixture views once more, as plain SQL for an independent engine."""

BASE = """
base AS (
  SELECT o_orderkey AS k, o_orderdate AS d0, CAST(o_totalprice AS DECIMAL(12,2)) AS amt0,
         CAST(o_orderkey AS VARCHAR(20)) AS expense_id, CAST(o_custkey AS VARCHAR(20)) AS user_id,
         CONCAT('merchant-', CAST(o_custkey % 40 AS VARCHAR(20))) AS merchant,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR(20)) AS expense_date,
         o_orderpriority AS shopping_type, o_orderstatus AS payment_method,
         (o_orderkey % 3 = 0) AS recurring
  FROM orders)"""

CDC = """
seqs4 AS (SELECT 0 AS seq UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3),
cdc AS (
  SELECT b.expense_id, b.user_id,
         CONCAT(b.shopping_type, ' at ', b.merchant, CASE WHEN q.seq >= 1 AND b.k % 4 = 0 THEN ' (corrected)' ELSE '' END) AS description,
         b.merchant,
         CAST(b.amt0 + CASE WHEN q.seq >= 1 AND b.k % 4 = 0 THEN 2.50 ELSE 0 END
                     + CASE WHEN q.seq >= 2 AND b.k % 8 = 0 THEN 5.00 ELSE 0 END AS DECIMAL(12,2)) AS expense_amount,
         b.expense_date, b.shopping_type, b.payment_method, b.recurring, 'expenses' AS cdc_table,
         CASE WHEN q.seq = 0 AND b.k % 10 = 0 THEN 'snapshot' WHEN q.seq = 0 THEN 'insert'
              WHEN q.seq = 3 THEN 'delete' ELSE 'update' END AS cdc_operation,
         b.d0 + q.seq * INTERVAL '1' DAY AS cdc_ts, q.seq + 1 AS commit_id
  FROM base b CROSS JOIN seqs4 q
  WHERE q.seq = 0 OR (q.seq = 1 AND b.k % 4 = 0) OR (q.seq = 2 AND b.k % 8 = 0) OR (q.seq = 3 AND b.k % 7 = 0))"""

LIVE = """
live AS (
  SELECT expense_id, user_id, CONCAT(shopping_type, ' at ', merchant, CASE WHEN k % 4 = 0 THEN ' (corrected)' ELSE '' END) AS description,
         merchant,
         CAST(amt0 + CASE WHEN k % 4 = 0 THEN 2.50 ELSE 0 END + CASE WHEN k % 8 = 0 THEN 5.00 ELSE 0 END AS DECIMAL(12,2)) AS expense_amount,
         expense_date, shopping_type, payment_method, recurring
  FROM base WHERE k % 7 <> 0)"""

SNAP = """
snap AS (
  SELECT expense_id, merchant, shopping_type, amt0 AS expense_amount, '2024-01-01 00:00:00' AS snapshot_timestamp FROM base WHERE k % 5 <> 0
  UNION ALL
  SELECT expense_id, merchant, shopping_type, CAST(amt0 + CASE WHEN k % 4 = 0 THEN 2.50 ELSE 0 END AS DECIMAL(12,2)), '2024-01-02 00:00:00' FROM base WHERE k % 5 <> 0)"""

COMMITS = """
commits AS (
  SELECT commit_id, CASE WHEN commit_id > 1 THEN commit_id - 1 END AS parent_id, 'append' AS operation,
         TIMESTAMP '2024-01-01 00:00:00' + (commit_id - 1) * INTERVAL '1' DAY AS committed_at, COUNT(*) AS added_rows
  FROM cdc GROUP BY commit_id)"""

ORDER_ENTRY = """
seqs2 AS (SELECT 0 AS seq UNION ALL SELECT 1),
t_order AS (
  SELECT CAST(o_orderkey AS VARCHAR(40)) AS o_id, CAST(o_orderkey % 10 + 1 AS VARCHAR(40)) AS o_d_id, '1' AS o_w_id, CAST(o_custkey AS VARCHAR(40)) AS o_c_id,
         CAST(5 + o_orderkey % 11 AS VARCHAR(40)) AS o_ol_cnt, CASE WHEN seq = 1 THEN CAST(o_orderkey % 10 + 1 AS VARCHAR(40)) ELSE '' END AS o_carrier_id, 'order' AS cdc_table,
         CASE WHEN seq = 1 THEN 'update' WHEN o_orderkey % 10 = 0 THEN 'snapshot' ELSE 'insert' END AS cdc_operation,
         o_orderdate + seq * INTERVAL '1' DAY AS cdc_ts
  FROM orders CROSS JOIN seqs2 WHERE seq = 0 OR o_orderkey % 4 = 0),
t_order_line AS (
  SELECT CAST(l_orderkey AS VARCHAR(40)) AS ol_o_id, CAST(l_suppkey % 10 + 1 AS VARCHAR(40)) AS ol_d_id, CAST(l_linenumber AS VARCHAR(40)) AS ol_number,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR(40)) AS ol_amount, 'order_line' AS cdc_table,
         CASE WHEN seq = 1 THEN 'update' WHEN l_orderkey % 10 = 0 THEN 'snapshot' ELSE 'insert' END AS cdc_operation,
         l_shipdate + seq * INTERVAL '1' DAY AS cdc_ts
  FROM lineitem CROSS JOIN seqs2 WHERE seq = 0 OR (l_orderkey % 4 = 0 AND l_linenumber = 1)),
t_new_order AS (
  SELECT CAST(o_orderkey AS VARCHAR(40)) AS no_o_id, CAST(o_orderkey % 10 + 1 AS VARCHAR(40)) AS no_d_id, 'new_order' AS cdc_table,
         CASE WHEN seq = 1 THEN 'delete' ELSE 'insert' END AS cdc_operation, o_orderdate + seq * INTERVAL '1' DAY AS cdc_ts
  FROM orders CROSS JOIN seqs2 WHERE o_orderstatus <> 'F' AND (seq = 0 OR o_orderkey % 3 <> 0)),
t_customer AS (
  SELECT CAST(c_custkey AS VARCHAR(40)) AS c_id, CAST(c_nationkey % 10 + 1 AS VARCHAR(40)) AS c_d_id, '1' AS c_w_id, c_name AS c_last,
         CASE WHEN c_custkey % 10 = 0 THEN 'BC' ELSE 'GC' END AS c_credit,
         CAST(CAST(CASE WHEN c_custkey % 50 = 0 THEN 0 ELSE c_acctbal END AS DECIMAL(12,2)) + CAST(seq * 100 AS DECIMAL(12,2)) AS VARCHAR(40)) AS c_balance,
         CAST(c_custkey % 37 + seq AS VARCHAR(40)) AS c_payment_cnt, 'customer' AS cdc_table,
         CASE WHEN seq = 1 THEN 'update' ELSE 'snapshot' END AS cdc_operation, TIMESTAMP '2024-01-01 00:00:00' + seq * INTERVAL '1' DAY AS cdc_ts
  FROM customer CROSS JOIN seqs2 WHERE seq = 0 OR c_custkey % 5 = 0),
t_district AS (
  SELECT CAST(n_nationkey AS VARCHAR(40)) AS d_id, CAST(n_regionkey AS VARCHAR(40)) AS d_w_id, n_name AS d_name, CAST(30000 + 100 * seq AS VARCHAR(40)) AS d_ytd, 'district' AS cdc_table,
         CASE WHEN seq = 1 THEN 'update' ELSE 'snapshot' END AS cdc_operation, TIMESTAMP '2024-01-01 00:00:00' + seq * INTERVAL '1' DAY AS cdc_ts
  FROM nation CROSS JOIN seqs2 WHERE seq = 0 OR n_nationkey % 2 = 0),
t_warehouse AS (
  SELECT CAST(r_regionkey AS VARCHAR(40)) AS w_id, r_name AS w_name, 'warehouse' AS cdc_table, 'snapshot' AS cdc_operation, TIMESTAMP '2024-01-01 00:00:00' AS cdc_ts FROM region),
t_stock AS (
  SELECT CAST(p_partkey AS VARCHAR(40)) AS s_i_id, '1' AS s_w_id, CAST(CASE WHEN seq = 1 THEN p_size + 1 ELSE p_size END AS VARCHAR(40)) AS s_quantity,
         CAST(p_partkey % 53 + seq AS VARCHAR(40)) AS s_order_cnt, CAST(p_partkey % 7 AS VARCHAR(40)) AS s_remote_cnt, 'stock' AS cdc_table,
         CASE WHEN seq = 1 THEN 'update' ELSE 'snapshot' END AS cdc_operation, TIMESTAMP '2024-01-01 00:00:00' + seq * INTERVAL '1' DAY AS cdc_ts
  FROM part CROSS JOIN seqs2 WHERE seq = 0 OR p_partkey % 3 = 0),
t_history AS (
  SELECT CAST(event_id AS VARCHAR(40)) AS rowid, CAST(user_id AS VARCHAR(40)) AS h_c_id, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR(40)) AS h_amount, 'history' AS cdc_table, 'insert' AS cdc_operation, ts AS cdc_ts
  FROM events WHERE event_type = 'purchase'),
t_item AS (
  SELECT CAST(p_partkey AS VARCHAR(40)) AS i_id, p_name AS i_name, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR(40)) AS i_price, 'item' AS cdc_table,
         'snapshot' AS cdc_operation, TIMESTAMP '2024-01-01 00:00:00' AS cdc_ts
  FROM part)"""


def expenses(sql: str) -> str:
    """``sql`` over base, cdc, live, snap and commits."""
    return "WITH " + ",".join([BASE, CDC, LIVE, SNAP, COMMITS]) + "\n" + sql


def order_entry(sql: str) -> str:
    """``sql`` over the order-entry views."""
    return "WITH " + ORDER_ENTRY + "\n" + sql


def everything(sql: str) -> str:
    """``sql`` over all views."""
    return "WITH " + ",".join([BASE, CDC, LIVE, SNAP, COMMITS, ORDER_ENTRY]) + "\n" + sql
