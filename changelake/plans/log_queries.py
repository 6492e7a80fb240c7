"""Reports over the change log, the live table and the snapshots."""

from __future__ import annotations

from changelake.functions.sized import top_k
from changelake.operators import reports as R
from changelake.operators import state as S
from changelake.plans import fixtures as X
from changelake.plans.catalogue import Catalogue
from changelake.plans.oracle_views import expenses as sql
from changelake.schemas import DELETE
from pyspark.sql import functions as F

AUDITED_EXPENSE = "56"  # seen, corrected twice, deleted
STATE_KEYS = ["expense_id"]
STATE_ORDER = ["cdc_ts", "commit_id"]
IMAGE = "expense_id, user_id, description, merchant, CAST(expense_amount AS DOUBLE) AS expense_amount, expense_date, shopping_type, payment_method, recurring"


def state_view(df):
    """A log or table image with amounts shown as reports show them."""
    return df.withColumn("expense_amount", R.shown(R.amount()))


def register(c: Catalogue) -> None:
    # -- change log ------------------------------------------------------
    c.add(
        "all_changes",
        lambda s, d: R.all_changes(X.log(s, d)),
        sql("SELECT expense_id, merchant, CAST(expense_amount AS DOUBLE) AS expense_amount, cdc_operation, cdc_ts FROM cdc ORDER BY cdc_ts DESC"),
    )
    c.add(
        "audit_trail_one",
        lambda s, d: R.audit_trail(X.log(s, d), AUDITED_EXPENSE),
        sql(f"""SELECT expense_id, description, CAST(expense_amount AS DOUBLE) AS expense_amount, payment_method, cdc_operation, cdc_ts
FROM cdc WHERE expense_id = '{AUDITED_EXPENSE}' ORDER BY cdc_ts"""),
    )
    c.add(
        "operation_counts",
        lambda s, d: R.operation_counts(X.log(s, d)),
        sql("SELECT cdc_operation, COUNT(*) AS event_count FROM cdc GROUP BY cdc_operation"),
    )
    c.add(
        "operation_totals",
        lambda s, d: R.operation_totals(X.log(s, d)),
        sql("SELECT cdc_operation, COUNT(*) AS event_count, CAST(SUM(expense_amount) AS DOUBLE) AS total_amount FROM cdc GROUP BY cdc_operation ORDER BY event_count DESC"),
    )
    for name, key in (("spending_by_category", "shopping_type"), ("spending_by_user", "user_id"), ("recurring_split", "recurring")):
        c.add(
            name,
            lambda s, d, key=key: R.spending_by(X.log(s, d), key),
            sql(f"""SELECT {key}, CAST(SUM(expense_amount) AS DOUBLE) AS total_spend, COUNT(*) AS txn_count
FROM cdc WHERE cdc_operation <> 'delete' GROUP BY {key} ORDER BY total_spend DESC"""),
        )
    c.add(
        "category_share",
        lambda s, d: R.category_share(X.log(s, d)),
        sql("""SELECT category, CAST(total AS DOUBLE) AS total, 100.0::DOUBLE * CAST(total AS DOUBLE) / CAST((SELECT SUM(expense_amount) FROM cdc WHERE cdc_operation <> 'delete') AS DOUBLE) AS share_pct
FROM (SELECT shopping_type AS category, SUM(expense_amount) AS total FROM cdc WHERE cdc_operation <> 'delete' GROUP BY shopping_type) t"""),
    )
    c.add(
        "operation_share",
        lambda s, d: R.operation_share(X.log(s, d)),
        sql("""SELECT operation, event_count, 100.0::DOUBLE * CAST(event_count AS DOUBLE) / CAST((SELECT COUNT(*) FROM cdc) AS DOUBLE) AS share_pct
FROM (SELECT cdc_operation AS operation, COUNT(*) AS event_count FROM cdc GROUP BY cdc_operation) t"""),
    )
    c.add(
        "top_merchants_dashboard",
        lambda s, d: R.spending_by(X.log(s, d), "merchant", exclude=(DELETE,), n=10),
        sql("""SELECT merchant, CAST(SUM(expense_amount) AS DOUBLE) AS total_spend, COUNT(*) AS txn_count
FROM cdc WHERE cdc_operation <> 'delete' GROUP BY merchant ORDER BY total_spend DESC, merchant LIMIT 10"""),
    )
    c.add(
        "top_merchants",
        lambda s, d: R.top_merchants(X.log(s, d)),
        sql("""SELECT merchant, CAST(SUM(expense_amount) AS DOUBLE) AS total_spend, COUNT(*) AS txn_count,
CAST(SUM(expense_amount) AS DOUBLE) / COUNT(*) AS avg_txn
FROM cdc WHERE cdc_operation IN ('insert', 'update') GROUP BY merchant ORDER BY total_spend DESC"""),
    )
    c.add(
        "totals",
        lambda s, d: R.totals(X.log(s, d)),
        sql("""SELECT COUNT(*) AS total_events,
CAST(SUM(CASE WHEN cdc_operation <> 'delete' THEN expense_amount ELSE 0 END) AS DOUBLE) AS total_spend,
COUNT(DISTINCT expense_id) AS unique_expenses, COUNT(DISTINCT merchant) AS unique_merchants FROM cdc"""),
    )
    c.add(
        "recent_changes",
        lambda s, d: R.recent_changes(X.log(s, d)),
        sql("""SELECT expense_id, merchant, CAST(expense_amount AS DOUBLE) AS expense_amount, cdc_operation, cdc_ts, shopping_type
FROM cdc ORDER BY cdc_ts DESC, expense_id, cdc_operation LIMIT 20"""),
    )
    c.add("log_row_count", lambda s, d: R.row_count(X.log(s, d)), sql("SELECT COUNT(*) AS row_count FROM cdc"))

    # -- state -----------------------------------------------------------
    state_columns = f"{IMAGE}, cdc_table, cdc_operation, cdc_ts, commit_id"
    c.add(
        "current_state",
        lambda s, d: state_view(S.current_state(X.log(s, d), STATE_KEYS, STATE_ORDER)),
        sql(f"""SELECT {state_columns} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY expense_id ORDER BY cdc_ts DESC, commit_id DESC) AS rn FROM cdc) t
WHERE rn = 1 AND cdc_operation <> 'delete'"""),
    )
    c.add(
        "current_state_maxjoin",
        lambda s, d: state_view(S.current_state_maxjoin(X.log(s, d), STATE_KEYS)),
        sql(f"""SELECT {state_columns} FROM cdc e
JOIN (SELECT expense_id AS latest_id, MAX(cdc_ts) AS latest FROM cdc GROUP BY expense_id) m
  ON e.expense_id = m.latest_id AND e.cdc_ts = m.latest WHERE cdc_operation <> 'delete'"""),
    )
    c.add(
        "current_state_totals",
        lambda s, d: R.spending_by(S.current_state(X.log(s, d), STATE_KEYS, STATE_ORDER, ["shopping_type", "expense_amount"]), "shopping_type", exclude=()),
        sql("""SELECT shopping_type, CAST(SUM(expense_amount) AS DOUBLE) AS total_spend, COUNT(*) AS txn_count
FROM live GROUP BY shopping_type ORDER BY total_spend DESC"""),
    )
    c.add(
        "most_modified_audit",
        lambda s, d: S.most_modified_audit(X.log(s, d)),
        sql("""SELECT expense_id, cdc_operation, CAST(expense_amount AS DOUBLE) AS expense_amount, description, cdc_ts FROM cdc
WHERE expense_id IN (SELECT expense_id FROM (
  SELECT expense_id, COUNT(*) AS n FROM cdc GROUP BY expense_id HAVING COUNT(*) > 1 ORDER BY n DESC, expense_id LIMIT 5) p)
ORDER BY expense_id, cdc_ts"""),
    )
    c.add(
        "fold_log_to_live",
        lambda s, d: state_view(S.fold(None, X.log(s, d), STATE_KEYS, STATE_ORDER)),
        sql(f"SELECT {IMAGE} FROM live"),
    )
    c.add(
        "fold_log_onto_base",
        lambda s, d: state_view(
            S.fold(X.first_live(s, d), X.log(s, d).filter("commit_id > 1"), STATE_KEYS, STATE_ORDER)
        ),
        sql(f"SELECT {IMAGE} FROM live"),
    )

    # -- live and snapshot tables ---------------------------------------
    c.add("live_sample", lambda s, d: R.sample_rows(state_view(X.live(s, d))))
    c.add("live_count", lambda s, d: R.row_count(X.live(s, d), "total_expenses"), sql("SELECT COUNT(*) AS total_expenses FROM live"))
    c.add(
        "live_by_category",
        lambda s, d: R.category_summary(X.live(s, d)),
        sql("SELECT shopping_type, COUNT(*) AS transactions, CAST(ROUND(SUM(expense_amount), 2) AS DOUBLE) AS total_spend FROM live GROUP BY shopping_type ORDER BY total_spend DESC"),
    )
    c.add(
        "live_top5_merchants",
        lambda s, d: R.spending_by(X.live(s, d), "merchant", exclude=(), n=5),
        sql("SELECT merchant, CAST(SUM(expense_amount) AS DOUBLE) AS total_spend, COUNT(*) AS txn_count FROM live GROUP BY merchant ORDER BY total_spend DESC, merchant LIMIT 5"),
    )
    c.add(
        "live_summary",
        lambda s, d: R.live_summary(X.live(s, d)),
        sql("SELECT 'complete' AS status, COUNT(*) AS remaining_rows, COUNT(DISTINCT shopping_type) AS categories, COUNT(DISTINCT merchant) AS merchants FROM live"),
    )
    c.add("snapshot_count", lambda s, d: R.row_count(X.snapshots(s, d), "snapshot_rows"), sql("SELECT COUNT(*) AS snapshot_rows FROM snap"))
    c.add(
        "snapshot_by_category",
        lambda s, d: R.category_summary(X.snapshots(s, d)),
        sql("SELECT shopping_type, COUNT(*) AS transactions, CAST(ROUND(SUM(expense_amount), 2) AS DOUBLE) AS total_spend FROM snap GROUP BY shopping_type ORDER BY total_spend DESC"),
    )
    c.add(
        "description_search",
        lambda s, d: R.description_search(X.live(s, d), "%(corrected)%"),
        sql("SELECT expense_id, CAST(expense_amount AS DOUBLE) AS expense_amount, description FROM live WHERE description LIKE '%(corrected)%' ORDER BY expense_amount DESC"),
    )
    c.add(
        "busiest_user_expenses",
        lambda s, d: busiest_user_expenses(X.live(s, d)),
        sql(f"""SELECT {IMAGE} FROM live
WHERE user_id = (SELECT user_id FROM live GROUP BY user_id ORDER BY COUNT(*) DESC, user_id LIMIT 1)"""),
    )


def busiest_user_expenses(live):
    """All rows of the user found by a scalar subquery."""
    by_user = live.groupBy("user_id").agg(R.rows().alias("n"))
    user = top_k(by_user, 1, F.desc("n"), F.col("user_id")).select("user_id").scalar()
    return state_view(live.filter(F.col("user_id") == user))
