"""Queries over a log that is kept in shape: compacted, published, folded, summed up."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake import workdir
from changelake.operators import reports as R
from changelake.operators import versions as V
from changelake.plans import envelope_fixtures as EF
from changelake.plans import fixtures as X
from changelake.plans.catalogue import Catalogue
from changelake.plans.envelope_queries import INGEST_TS, PAIR_LOG, shown_rows
from changelake.plans.lake_queries import COMMITS, FIRST_STAMP, SECOND_STAMP, mixed_feed, new_database, normalized_log, snapshot_table, written_log
from changelake.plans.log_queries import AUDITED_EXPENSE, IMAGE, state_view
from changelake.plans.oracle_views import expenses as sql
from changelake.schemas import EXPENSES
from changelake.sinks import catalog_log, compaction, image, partials
from changelake.sinks import log as log_sink
from changelake.sinks import snapshot
from changelake.sources import catalog, events, lake
from changelake.streaming import ingest, staging


def compacted_log(spark: SparkSession, sf_dir: str) -> str:
    """The written log, first commits 1 and 2 compacted, then all but the newest; old folders are gone."""
    base = written_log(spark, sf_dir)
    for keep in (2, 1):
        compaction.compact(spark, base, keep=keep)
        compaction.vacuum(spark, base)
    return base


def files_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after a compaction, and whether there are fewer files."""
    base = written_log(spark, sf_dir)
    counted = []
    for name in ("before", "after"):
        inventory = V.file_inventory(lake.read_log(spark, base, with_files=True))
        path = workdir.fresh(spark, f"inventory-{name}")
        inventory.agg(F.count("*").alias("files"), F.sum("record_count").alias("row_count")).select(F.lit(name).alias("state"), "*").write.parquet(path)
        counted.append(spark.read.parquet(path))
        compaction.compact(spark, base)
    both = reduce(DataFrame.unionByName, counted).groupBy().pivot("state", ["before", "after"]).agg(F.first("files").alias("files"), F.first("row_count").alias("rows"))
    return both.select(F.col("before_rows").alias("rows_before"), F.col("after_rows").alias("rows_after"), (F.col("after_files") < F.col("before_files")).alias("fewer_files"))


def lost_then_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both tables after an attempt at two was lost and the next one had expenses only."""
    base = workdir.fresh(spark, "lost")
    feed = mixed_feed(spark, sf_dir)
    lost = workdir.fresh(spark, "lost-attempt")
    ingest.write_batch(feed.filter("o_orderkey % 3 <> 1").select("value", "received_at"), lost, 1)
    log_sink.append_log(lake.read_log(spark, lost, "warehouse").drop("commit_id"), base, "warehouse", 1)
    ingest.write_batch(feed.filter("o_orderkey % 3 = 2").select("value", "received_at"), base, 1)
    keys = [lake.read_log(spark, base, t).select(F.lit(t).alias("table_name"), F.col(k).alias("key")) for t, k in (("expenses", "expense_id"), ("warehouse", "w_id"))]
    return reduce(DataFrame.unionByName, keys)


def summed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partial figures of the written log's commits."""
    base = written_log(spark, sf_dir)
    log = lake.read_log(spark, base)
    for commit_id in COMMITS:
        partials.write_partials(log.filter(F.col("commit_id") == commit_id), base, commit_id)
    return lake.read_partials(spark, base, partials.partials(log).schema)


def folded_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image brought to commit 2 and then to the newest; the log is compacted in between."""
    base, name = written_log(spark, sf_dir), f"`{new_database(spark)}`.`expenses_image`"
    image.create_image(spark, name)
    image.fold_commits(spark, base, name, to=2)
    compaction.compact(spark, base)
    image.fold_commits(spark, base, name)
    return image.read_image(spark, name).select(*EXPENSES.fieldNames())


def published_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log by its catalog name, from another session, published before and after a compaction."""
    base, database = written_log(spark, sf_dir), new_database(spark)
    catalog_log.publish(spark, base, database, ["expenses"])
    compaction.compact(spark, base, keep=1)
    (name,) = catalog_log.publish(spark, base, database, ["expenses"])
    return spark.newSession().table(name)


def appended_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two commits appended to a catalog table, the second one delivered again."""
    name = f"`{new_database(spark)}`.`expenses`"
    spark.sql(catalog_log.create_log_table_sql(name, "expenses"))
    kept = workdir.fresh(spark, "normalized")  # read by every commit, normalized once
    normalized_log(spark, sf_dir).write.parquet(kept)
    log = spark.read.parquet(kept)
    for commit_id in (1, 2, 2):
        catalog_log.append_commit(log.filter(F.pmod(F.crc32(F.col("expense_id").cast("binary")), F.lit(2)) == commit_id - 1), name, commit_id)
    return spark.table(name).groupBy("shopping_type").agg(R.rows().alias("row_count"), R.total().alias("total"))


def resumed_log(spark: SparkSession, sf_dir: str) -> str:
    """Half of the feed landed, its checkpoint lost, then all of it offered to a query that starts anew."""
    landing, base = workdir.fresh(spark, "landing"), workdir.fresh(spark, "resumed")
    feed = X.spread(X.changes(spark, sf_dir)).select("seq", EF.pair_event(F.col("seq"), X.change_time()).alias("value"))
    for part, resume in ((F.col("seq") <= 1, False), (F.col("seq") > 1, True)):
        feed.filter(part).write.mode("append").partitionBy("seq").text(landing)
        files = catalog.list_output(spark, landing, n=1, pattern="*.txt").first()["total_files"]
        stream = events.stream_events(spark, landing, max_files=max(1, -(-files // 2)))
        ingest.run_available(stream, base, workdir.fresh(spark, "checkpoint"), INGEST_TS, resume=resume)
    return base


def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of one expense, from a log that is partly compacted."""
    base = written_log(spark, sf_dir)
    compaction.compact(spark, base, keep=2)
    return R.audit_trail(lake.read_log(spark, base), AUDITED_EXPENSE).withColumn("cdc_ts", F.col("cdc_ts").cast("timestamp_ntz"))


def counted_by_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts that the catalog keeps of a snapshot and of a log."""
    live, log = snapshot_table(spark), f"`{new_database(spark)}`.`expenses`"
    snapshot.materialize_snapshot(X.live(spark, sf_dir), live, FIRST_STAMP)
    spark.sql(catalog_log.create_log_table_sql(log, "expenses"))
    catalog_log.append_commit(normalized_log(spark, sf_dir), log, 1)
    catalog.analyze(spark, [live, log])
    found = catalog.estimated_row_counts(spark, [live, log])
    return found.withColumn("table_name", F.regexp_extract("table_name", r"`(\w+)`$", 1))


def snapshot_by_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of the first images brought to the newest commit by what the log says has changed."""
    base, table = written_log(spark, sf_dir), snapshot_table(spark)
    snapshot.materialize_snapshot(X.first_live(spark, sf_dir), table, FIRST_STAMP)
    snapshot.mark_version(spark, table, 1)
    snapshot.refresh_by_log(X.live(spark, sf_dir), lake.read_log(spark, base), table, max(COMMITS), SECOND_STAMP)
    return spark.table(table)


def typed_misc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unregistered table whose members change type, and of which one is new, from one commit to the next."""
    orders, base = X.table(spark, sf_dir, "orders"), workdir.fresh(spark, "typed")
    named = F.lit("misc").alias("__table__")
    first = F.struct(named, F.col("o_orderkey").alias("k"), F.col("o_orderkey").alias("amount"), (F.col("o_orderkey") % 4 == 1).alias("flag"))
    second = F.struct(
        named, F.col("o_orderkey").alias("k"), F.col("o_totalprice").cast("decimal(12,2)").alias("amount"), F.col("o_orderstatus").alias("flag"), F.col("o_custkey").alias("customer")
    )
    for commit_id, image in ((1, first), (2, second)):
        half = orders.filter(F.col("o_orderkey") % 2 == commit_id % 2)
        ingest.write_batch(half.select(F.to_json(image).alias("value")), base, commit_id, INGEST_TS)
    return lake.read_typed_rows(spark, base, "misc").select("k", "amount", "flag", "customer", "commit_id")


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four micro-batches half a minute apart; a busy table is due each time, a quiet one once it has waited 75 seconds."""
    base, began = workdir.fresh(spark, "staged"), datetime(2024, 6, 1, tzinfo=timezone.utc)
    orders = X.table(spark, sf_dir, "orders")
    busy = F.struct(F.col("o_orderkey").cast("string").alias("expense_id"), F.col("o_totalprice").cast("decimal(12,2)").alias("expense_amount"))
    quiet = F.struct(F.col("o_orderkey").alias("w_id"), F.col("o_orderstatus").alias("w_name"), F.lit("").alias("w_street_1"))
    feed = X.spread(orders).select("o_orderkey", F.when(F.expr("o_orderkey DIV 4 % 16 = 0"), F.to_json(quiet)).otherwise(F.to_json(busy)).alias("value"))
    most = orders.count() // 8
    for k in range(4):
        now = began + timedelta(seconds=30 * k)
        staging.stage_batch(feed.filter(F.col("o_orderkey") % 4 == k).select("value"), base, k, INGEST_TS, now)
        staging.release(spark, base, most, 75, now)
    keys = [lake.read_log(spark, base, t).select(F.lit(t).alias("table_name"), F.col(k).alias("key"), "commit_id") for t, k in (("expenses", "expense_id"), ("warehouse", "w_id"))]
    return reduce(DataFrame.unionByName, keys)


def register(c: Catalogue) -> None:
    log_columns = f"{IMAGE}, cdc_table, cdc_operation, cdc_ts, CAST(commit_id AS BIGINT) AS commit_id"
    c.add("log_after_compaction", lambda s, d: shown_rows(lake.read_log(s, compacted_log(s, d))), sql(f"SELECT {log_columns} FROM cdc"))
    c.add(
        "log_as_of_compacted",
        lambda s, d: shown_rows(V.as_of(lake.read_log(s, compacted_log(s, d)), 2)),
        sql(f"SELECT {log_columns} FROM cdc WHERE commit_id <= 2"),
    )
    c.add("compaction_files", files_saved, sql("SELECT COUNT(*) AS rows_before, COUNT(*) AS rows_after, TRUE AS fewer_files FROM cdc"))
    c.add("log_after_lost_commit", lost_then_landed, "SELECT 'expenses' AS table_name, CAST(o_orderkey AS VARCHAR) AS key FROM orders WHERE o_orderkey % 3 = 2")
    for grain in partials.GRAINS[:3]:
        c.add(
            f"spending_from_partials_{grain}" if grain != "shopping_type" else "spending_from_partials",
            lambda s, d, grain=grain: partials.spending_by(summed_log(s, d), grain),
            sql(f"SELECT {grain}, CAST(SUM(expense_amount) AS DOUBLE) AS total_spend, COUNT(*) AS txn_count FROM cdc WHERE cdc_operation <> 'delete' GROUP BY {grain}"),
        )
    c.add(
        "operation_totals_from_partials",
        lambda s, d: partials.operation_totals(summed_log(s, d)),
        sql("SELECT cdc_operation, COUNT(*) AS event_count, CAST(SUM(expense_amount) AS DOUBLE) AS total_amount FROM cdc GROUP BY cdc_operation"),
    )
    c.add(
        "amount_ranges_from_partials",
        lambda s, d: partials.amount_ranges(summed_log(s, d), "recurring").withColumns({t: F.col(t).cast("timestamp_ntz") for t in ("first_ts", "last_ts")}),
        sql("""SELECT recurring, CAST(MIN(expense_amount) AS DOUBLE) AS amount_min, CAST(MAX(expense_amount) AS DOUBLE) AS amount_max,
CAST(SUM(expense_amount) AS DOUBLE) / COUNT(expense_amount) AS amount_avg, MIN(cdc_ts) AS first_ts, MAX(cdc_ts) AS last_ts FROM cdc WHERE cdc_operation <> 'delete' GROUP BY recurring"""),
    )
    c.add("image_after_commits", lambda s, d: state_view(folded_image(s, d)), sql(f"SELECT {IMAGE} FROM live"))
    c.add(
        "catalog_log_spending",
        lambda s, d: R.spending_by(published_log(s, d), "shopping_type"),
        sql("SELECT shopping_type, CAST(SUM(expense_amount) AS DOUBLE) AS total_spend, COUNT(*) AS txn_count FROM cdc WHERE cdc_operation <> 'delete' GROUP BY shopping_type"),
    )
    c.add(
        "catalog_append_replayed",
        appended_twice,
        sql("SELECT shopping_type, COUNT(*) AS row_count, CAST(SUM(expense_amount) AS DOUBLE) AS total FROM cdc GROUP BY shopping_type"),
    )
    c.add("log_after_lost_checkpoint", lambda s, d: shown_rows(lake.read_log(s, resumed_log(s, d)), "commit_id"), PAIR_LOG)
    c.add(
        "audit_trail_written",
        audited,
        sql(f"""SELECT expense_id, description, CAST(expense_amount AS DOUBLE) AS expense_amount, payment_method, cdc_operation, cdc_ts
FROM cdc WHERE expense_id = '{AUDITED_EXPENSE}' ORDER BY cdc_ts"""),
    )
    c.add(
        "estimated_row_counts",
        counted_by_catalog,
        sql("SELECT 'expenses_snapshot' AS table_name, COUNT(*) AS row_count FROM live UNION ALL SELECT 'expenses', COUNT(*) FROM cdc"),
    )
    c.add(
        "snapshot_refreshed_by_log",
        lambda s, d: state_view(snapshot_by_log(s, d)),
        sql(f"SELECT {IMAGE}, CASE WHEN shopping_type IN (SELECT shopping_type FROM cdc WHERE commit_id > 1) THEN '{SECOND_STAMP}' ELSE '{FIRST_STAMP}' END AS snapshot_timestamp FROM live"),
    )
    c.add(
        "unregistered_typed",
        typed_misc,
        """SELECT o_orderkey AS k, CAST(CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey ELSE o_totalprice END AS DOUBLE) AS amount,
CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus WHEN o_orderkey % 4 = 1 THEN 'true' ELSE 'false' END AS flag,
CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE 0 END AS customer, CASE WHEN o_orderkey % 2 = 1 THEN 1 ELSE 2 END AS commit_id FROM orders""",
    )
    c.add(
        "staged_tables",
        staged,
        """SELECT CASE WHEN o_orderkey // 4 % 16 = 0 THEN 'warehouse' ELSE 'expenses' END AS table_name, CAST(o_orderkey AS VARCHAR) AS key,
CASE WHEN o_orderkey // 4 % 16 = 0 THEN 4 ELSE o_orderkey % 4 + 1 END AS commit_id FROM orders""",
    )
