"""Round trips: encode the log into an envelope, normalize it, get the log back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake import workdir
from changelake.operators import envelope as N
from changelake.operators import reports as R
from changelake.operators import shaping as T
from changelake.plans import envelope_fixtures as V
from changelake.plans import fixtures as X
from changelake.plans.catalogue import Catalogue
from changelake.plans.log_queries import IMAGE
from changelake.plans.oracle_views import everything, expenses
from changelake.schemas import META_COLUMNS
from changelake.sources import kafka

INGEST_TS = "2024-06-01T00:00:00+00:00"


def shown_rows(df: DataFrame, *drop: str) -> DataFrame:
    """Expense rows as the oracle sees them: amounts as DOUBLE, zone-free times."""
    hidden = {"cdc_timestamp", "cdc_seq", "feed", *drop}
    out = df.withColumns({"expense_amount": R.shown(R.amount()), "cdc_ts": F.col("cdc_ts").cast("timestamp_ntz")})
    return out.select(*[c for c in out.columns if c not in hidden])


def expense_rows(raw: DataFrame) -> DataFrame:
    return shown_rows(T.typed_rows(N.normalize(raw, INGEST_TS).rows, "expenses"))


PAIR_LOG = expenses(
    f"""SELECT {IMAGE}, cdc_table,
CASE WHEN cdc_operation = 'snapshot' THEN 'insert' ELSE cdc_operation END AS cdc_operation, cdc_ts FROM cdc"""
)
FULL_LOG = expenses(f"SELECT {IMAGE}, cdc_table, cdc_operation, cdc_ts FROM cdc")


def as_messages(raw: DataFrame) -> DataFrame:
    """A feed as a message topic delivers it: binary values under a topic name."""
    return raw.select(F.col("feed").alias("topic"), F.col("value").cast("binary").alias("value"))


def detected_tables(raw: DataFrame) -> DataFrame:
    return N.normalize(raw, INGEST_TS).rows.groupBy("cdc_table").agg(R.rows().alias("row_count"))


def dead_letters(raw: DataFrame) -> DataFrame:
    return N.normalize(raw, INGEST_TS).dead.groupBy("reason").agg(R.rows().alias("dead_count"))


def cut_counts(raw: DataFrame) -> DataFrame:
    found = N.normalize_once(raw, workdir.fresh(raw.sparkSession, "classified"), INGEST_TS)
    return N.consistent_cut(found.rows, found.progress).groupBy("feed", "cdc_operation").agg(R.rows().alias("event_count"))


def text_map_counts(raw: DataFrame) -> DataFrame:
    """Members per table, counted over the generic text map."""
    rows = T.text_map_rows(N.normalize(raw, INGEST_TS).rows)
    named = rows.select("cdc_table", F.explode(F.map_keys("members")).alias("member"))
    return named.groupBy("cdc_table", "member").agg(R.rows().alias("row_count"))


ORDER_ENTRY_MEMBERS = {
    "order": "o_id o_d_id o_w_id o_c_id o_ol_cnt o_carrier_id",
    "order_line": "ol_o_id ol_d_id ol_number ol_amount",
    "new_order": "no_o_id no_d_id",
    "customer": "c_id c_d_id c_w_id c_last c_credit c_balance c_payment_cnt",
    "district": "d_id d_w_id d_name d_ytd",
    "warehouse": "w_id w_name",
    "stock": "s_i_id s_w_id s_quantity s_order_cnt s_remote_cnt",
    "history": "rowid h_c_id h_amount",
    "item": "i_id i_name i_price",
}
EXPENSE_MEMBERS = "expense_id user_id description merchant expense_amount expense_date shopping_type payment_method recurring"


def _member_counts() -> str:
    sources = [("expenses", "live", EXPENSE_MEMBERS), ("unknown", "events", "k")]
    sources += [(t, f"t_{t}", m) for t, m in ORDER_ENTRY_MEMBERS.items()]
    return " UNION ALL ".join(
        f"SELECT '{table}' AS cdc_table, '{m}' AS member, COUNT(*) AS row_count FROM {view}"
        for table, view, members in sources
        for m in members.split()
    )


def clashing_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an unregistered table with members named like a change column and like each other."""
    body = F.format_string('{"__table__": "odd", "A": %d, "a": "%s", "cdc_table": "%s"}', "o_orderkey", "o_orderpriority", "o_orderstatus")
    rows = N.normalize_once(X.table(spark, sf_dir, "orders").select(body.alias("value")), workdir.fresh(spark, "classified"), INGEST_TS).rows
    return T.inferred_rows(rows, "odd").drop("cdc_timestamp", *T.TIME_COLUMNS)


def register(c: Catalogue) -> None:
    c.add("normalize_before_after", lambda s, d: expense_rows(V.pair_feed(s, d)), PAIR_LOG)
    c.add("normalize_batch", lambda s, d: expense_rows(V.batch_feed(s, d)), PAIR_LOG)
    c.add("normalize_list", lambda s, d: expense_rows(V.list_feed(s, d)), PAIR_LOG)
    c.add("normalize_debezium", lambda s, d: expense_rows(V.coded_feed(s, d)), FULL_LOG)
    c.add("normalize_debezium_flat", lambda s, d: expense_rows(V.coded_flat_feed(s, d)), FULL_LOG)
    c.add(
        "normalize_messages",
        lambda s, d: expense_rows(kafka.decode(as_messages(V.coded_feed(s, d)))),
        FULL_LOG,
    )
    c.add(
        "normalize_direct_rows",
        lambda s, d: expense_rows(V.bare_feed(s, d)),
        expenses(f"SELECT {IMAGE}, 'expenses' AS cdc_table, 'snapshot' AS cdc_operation, TIMESTAMP '2024-06-01 00:00:00' AS cdc_ts FROM live"),
    )
    counts = ["SELECT 'expenses' AS cdc_table, COUNT(*) AS row_count FROM live", "SELECT 'unknown', COUNT(*) FROM events"]
    counts += [f"SELECT '{t}', COUNT(*) FROM t_{t}" for t in ORDER_ENTRY_MEMBERS]
    c.add("detect_tables", lambda s, d: detected_tables(V.order_entry_feed(s, d)), everything(" UNION ALL ".join(counts)))
    c.add("text_map_members", lambda s, d: text_map_counts(V.order_entry_feed(s, d)), everything(_member_counts()))
    c.add(
        "dead_letters",
        lambda s, d: dead_letters(V.broken_feed(s, d)),
        """SELECT * FROM (SELECT CASE o_orderkey % 10 WHEN 0 THEN 'invalid_json' WHEN 1 THEN 'delete_without_before' WHEN 2 THEN 'empty_after'
WHEN 3 THEN 'not_an_object' WHEN 4 THEN 'null_body' WHEN 5 THEN 'no_row_image' WHEN 6 THEN 'empty_row' WHEN 7 THEN 'row_not_an_object'
WHEN 8 THEN 'uncastable_expense_amount' END AS reason, COUNT(*) AS dead_count FROM orders GROUP BY 1) t WHERE reason IS NOT NULL""",
    )
    c.add(
        "surviving_rows",
        lambda s, d: expense_rows(V.broken_feed(s, d)),
        expenses(f"SELECT {IMAGE}, cdc_table, 'insert' AS cdc_operation, cdc_ts FROM cdc WHERE commit_id = 1 AND CAST(expense_id AS BIGINT) % 10 = 9"),
    )
    c.add(
        "default_fill",
        lambda s, d: shown_rows(T.typed_rows(N.normalize(V.sparse_feed(s, d), INGEST_TS).rows, "expenses")),
        """SELECT CAST(o_orderkey AS VARCHAR) AS expense_id, '' AS user_id, '' AS description,
CASE WHEN o_orderkey % 2 = 0 THEN CONCAT('merchant-', CAST(o_custkey % 40 AS VARCHAR)) WHEN o_orderkey % 3 = 0 THEN NULL ELSE '' END AS merchant,
CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(0 AS DOUBLE) END AS expense_amount, '' AS expense_date, '' AS shopping_type, '' AS payment_method,
FALSE AS recurring, 'expenses' AS cdc_table, 'snapshot' AS cdc_operation, TIMESTAMP '2024-06-01 00:00:00' AS cdc_ts FROM orders""",
    )
    c.add(
        "fill_defaults",
        lambda s, d: shown_rows(
            T.fill_defaults(T.typed_rows(N.normalize(V.sparse_feed(s, d), INGEST_TS).rows, "expenses"), "expenses"),
            *META_COLUMNS,
            "cdc_ts",
        ),
        """SELECT CAST(o_orderkey AS VARCHAR) AS expense_id, '' AS user_id, '' AS description,
CASE WHEN o_orderkey % 2 = 0 THEN CONCAT('merchant-', CAST(o_custkey % 40 AS VARCHAR)) ELSE '' END AS merchant,
CAST(0 AS DOUBLE) AS expense_amount, '' AS expense_date, '' AS shopping_type, '' AS payment_method, FALSE AS recurring FROM orders""",
    )
    c.add(
        "text_table_rows",
        lambda s, d: T.typed_rows(N.normalize(V.typed_order_feed(s, d), INGEST_TS).rows, "order").drop(*T.TIME_COLUMNS, "feed", "rest"),
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_id, '' AS o_d_id, '' AS o_w_id, CAST(o_custkey AS VARCHAR) AS o_c_id,
CONCAT('{{"code":"', o_orderstatus, '"}}') AS o_entry_d, '' AS o_carrier_id,
CASE WHEN CAST(o_totalprice AS DECIMAL(12,2)) % 1 = 0 THEN CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR)
     ELSE RTRIM(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), '0') END AS o_ol_cnt,
CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS o_all_local,
'order' AS cdc_table, 'snapshot' AS cdc_operation, '{INGEST_TS}' AS cdc_timestamp FROM orders""",
    )
    c.add(
        "all_text_columns",
        lambda s, d: T.all_strings(T.typed_rows(N.normalize(V.pair_feed(s, d), INGEST_TS).rows, "expenses").drop("feed", *T.TIME_COLUMNS, "cdc_timestamp")),
        expenses("""SELECT expense_id, user_id, description, merchant, CAST(expense_amount AS VARCHAR) AS expense_amount, expense_date, shopping_type, payment_method,
CASE WHEN recurring THEN 'true' ELSE 'false' END AS recurring, cdc_table,
CASE WHEN cdc_operation = 'snapshot' THEN 'insert' ELSE cdc_operation END AS cdc_operation FROM cdc"""),
    )
    c.add(
        "inferred_columns",
        lambda s, d: T.inferred_rows(N.normalize_once(V.part_feed(s, d), workdir.fresh(s, "classified"), INGEST_TS).rows, "part").drop(*T.TIME_COLUMNS),
        f"""SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, CASE WHEN p_partkey % 5 > 0 THEN p_brand ELSE '' END AS p_brand,
CASE WHEN p_partkey % 2 = 0 THEN FLOOR(p_retailprice) ELSE p_retailprice END AS p_retailprice,
'part' AS cdc_table, 'snapshot' AS cdc_operation, '{INGEST_TS}' AS cdc_timestamp FROM part""",
    )
    c.add(
        "resolved_progress",
        lambda s, d: N.progress(N.normalize(V.marked_feed(s, d), INGEST_TS).progress).withColumn(
            "resolved_ts", F.col("resolved_ts").cast("timestamp_ntz")
        ),
        "SELECT o_orderpriority AS feed, MAX(o_orderdate) AS resolved_ts FROM orders GROUP BY o_orderpriority",
    )
    c.add(
        "consistent_cut",
        lambda s, d: cut_counts(V.marked_feed(s, d)),
        expenses("""SELECT feed, cdc_operation, COUNT(*) AS event_count FROM (
  SELECT shopping_type AS feed, CASE WHEN cdc_operation = 'snapshot' THEN 'insert' ELSE cdc_operation END AS cdc_operation
  FROM cdc JOIN (SELECT o_orderpriority AS p, MAX(o_orderdate) AS resolved FROM orders GROUP BY o_orderpriority) r
    ON cdc.shopping_type = r.p WHERE cdc_ts <= resolved) t GROUP BY feed, cdc_operation"""),
    )
    c.add(
        "inferred_clashing_members",
        clashing_members,
        """SELECT o_orderkey AS "A", o_orderpriority AS a_2, o_orderstatus AS cdc_table_2, 'odd' AS cdc_table, 'snapshot' AS cdc_operation FROM orders""",
    )
