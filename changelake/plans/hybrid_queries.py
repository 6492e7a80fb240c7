"""Queries across the live table, the change log and the snapshots."""

from __future__ import annotations

from changelake.operators import hybrid as H
from changelake.plans import fixtures as X
from changelake.plans.catalogue import Catalogue
from changelake.plans.oracle_views import expenses as sql


def register(c: Catalogue) -> None:
    c.add(
        "two_source_counts",
        lambda s, d: H.source_counts(live=X.live(s, d), change_log=X.log(s, d)),
        sql("SELECT 'live' AS source, COUNT(*) AS total_rows FROM live UNION ALL SELECT 'change_log', COUNT(*) FROM cdc"),
    )
    parts = [
        f"SELECT '{label}' AS source, COUNT(*) AS total_rows, CAST(SUM(expense_amount) AS DOUBLE) AS total_spend, COUNT(DISTINCT merchant) AS merchants FROM {view}"
        for label, view in (("live", "live"), ("change_log", "cdc"), ("snapshot", "snap"))
    ]
    c.add(
        "three_source_compare",
        lambda s, d: H.compare_sources(live=X.live(s, d), change_log=X.log(s, d), snapshot=X.snapshots(s, d)),
        sql(" UNION ALL ".join(parts)),
    )
    c.add(
        "live_with_history",
        lambda s, d: H.live_with_history(X.live(s, d), X.log(s, d)),
        sql("""SELECT l.expense_id, l.merchant, CAST(l.expense_amount AS DOUBLE) AS current_amount, l.shopping_type,
CAST(c.expense_amount AS DOUBLE) AS historical_amount, c.cdc_operation, c.cdc_ts
FROM live l JOIN cdc c ON l.expense_id = c.expense_id ORDER BY c.cdc_ts DESC, l.expense_id, c.cdc_operation LIMIT 20"""),
    )
    c.add(
        "changed_amounts",
        lambda s, d: H.changed_amounts(X.live(s, d), X.log(s, d)),
        sql("""SELECT l.expense_id, l.merchant, CAST(l.expense_amount AS DOUBLE) AS current_amount, CAST(c.expense_amount AS DOUBLE) AS previous_amount,
CAST(ROUND(l.expense_amount - c.expense_amount, 2) AS DOUBLE) AS difference, c.cdc_operation, c.cdc_ts
FROM live l JOIN cdc c ON l.expense_id = c.expense_id WHERE c.cdc_operation = 'update'
ORDER BY ABS(l.expense_amount - c.expense_amount) DESC, l.expense_id, c.cdc_ts LIMIT 10"""),
    )
    c.add(
        "ghost_records",
        lambda s, d: H.ghost_records(X.log(s, d), X.live(s, d)),
        sql("""SELECT c.expense_id, c.merchant, CAST(c.expense_amount AS DOUBLE) AS expense_amount, c.shopping_type, c.cdc_ts AS deleted_at
FROM cdc c LEFT JOIN live l ON c.expense_id = l.expense_id WHERE l.expense_id IS NULL AND c.cdc_operation = 'delete' ORDER BY c.cdc_ts DESC"""),
    )
    c.add(
        "modification_audit",
        lambda s, d: H.modification_audit(X.live(s, d), X.log(s, d)),
        sql("""SELECT l.expense_id, l.merchant, CAST(l.expense_amount AS DOUBLE) AS current_amount, COUNT(c.cdc_operation) AS total_changes,
CAST(SUM(CASE WHEN c.cdc_operation = 'update' THEN 1 ELSE 0 END) AS BIGINT) AS updates, MIN(c.cdc_ts) AS first_seen, MAX(c.cdc_ts) AS last_changed
FROM live l JOIN cdc c ON l.expense_id = c.expense_id GROUP BY l.expense_id, l.merchant, l.expense_amount
HAVING COUNT(c.cdc_operation) > 1 ORDER BY total_changes DESC, l.expense_id LIMIT 20"""),
    )
    c.add(
        "full_lifecycle",
        lambda s, d: H.full_lifecycle(X.log(s, d), X.live(s, d), X.snapshots(s, d)),
        sql("""SELECT COALESCE(l.expense_id, c.expense_id) AS expense_id, CASE WHEN l.expense_id IS NOT NULL THEN 'Active' ELSE 'Deleted' END AS status,
COALESCE(l.merchant, c.merchant) AS merchant, CAST(l.expense_amount AS DOUBLE) AS live_amount, CAST(s.expense_amount AS DOUBLE) AS snapshot_amount,
COUNT(c.cdc_operation) AS total_cdc_events, MIN(c.cdc_ts) AS first_seen, MAX(c.cdc_ts) AS last_changed
FROM cdc c LEFT JOIN live l ON c.expense_id = l.expense_id
LEFT JOIN (SELECT * FROM snap WHERE snapshot_timestamp = (SELECT MAX(snapshot_timestamp) FROM snap)) s ON c.expense_id = s.expense_id
GROUP BY l.expense_id, c.expense_id, l.merchant, c.merchant, l.expense_amount, s.expense_amount
ORDER BY total_cdc_events DESC, c.expense_id, c.merchant LIMIT 20"""),
    )
    for name, first_seen, ops in (("price_drift", False, "('insert')"), ("price_drift_first_seen", True, "('insert', 'snapshot')")):
        c.add(
            name,
            lambda s, d, first_seen=first_seen: H.price_drift(X.live(s, d), X.log(s, d), first_seen=first_seen),
            sql(f"""SELECT l.expense_id, l.merchant, CAST(ROUND(l.expense_amount, 2) AS DOUBLE) AS current_amount,
CAST(ROUND(o.expense_amount, 2) AS DOUBLE) AS original_amount, CAST(ROUND(l.expense_amount - o.expense_amount, 2) AS DOUBLE) AS price_change
FROM live l JOIN (SELECT expense_id, expense_amount FROM cdc WHERE cdc_operation IN {ops}) o ON l.expense_id = o.expense_id
WHERE l.expense_amount <> o.expense_amount ORDER BY ABS(l.expense_amount - o.expense_amount) DESC, l.expense_id, o.expense_amount LIMIT 10"""),
        )
