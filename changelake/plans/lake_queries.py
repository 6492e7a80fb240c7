"""Round trips through sinks, streams and tables, and queries over versions.

These write below the session's shared folder, a fresh path per call, and
return a DataFrame over what was written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake import workdir
from changelake.operators import changes as C
from changelake.operators import envelope as N
from changelake.operators import reports as R
from changelake.operators import shaping as T
from changelake.operators import versions as V
from changelake.plans import envelope_fixtures as EF
from changelake.plans import fixtures as X
from changelake.plans.catalogue import Catalogue
from changelake.plans.envelope_queries import INGEST_TS, ORDER_ENTRY_MEMBERS, PAIR_LOG, shown_rows
from changelake.plans.log_queries import IMAGE, state_view
from changelake.plans.oracle_views import expenses as sql
from changelake.plans.oracle_views import order_entry as order_sql
from changelake.schemas import RAW_EVENT_TYPE, REGISTRY
from changelake.sinks import archive, ddl
from changelake.sinks import log as log_sink
from changelake.sinks import snapshot as snapshot_sink
from changelake.sources import catalog, lake
from changelake.sources import events as event_files
from changelake.sources import raw_changefeed as raw
from changelake.sources import series
from changelake.streaming import ingest, stats

FIRST_STAMP, SECOND_STAMP = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def normalized_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.typed_rows(N.normalize(EF.pair_feed(spark, sf_dir), INGEST_TS).rows, "expenses")


# -- sinks -------------------------------------------------------------------


def archived(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The log archived under the first day of each change's month."""
    base = workdir.fresh(spark, "archive")
    archive.write_archive(normalized_log(spark, sf_dir), base, "expenses", date=F.trunc("cdc_ts", "month"))
    return base, lake.read_archive(spark, base)


def raw_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = workdir.fresh(spark, "raw-changefeed")
    rows = EF.raw_changefeed(spark, sf_dir)
    first = F.col(RAW_EVENT_TYPE) == "c"
    rows.filter(first).write.parquet(f"{base}/2024-01-01")
    rows.filter(~first).write.parquet(f"{base}/2024-01-02")
    found = raw.read_raw_changefeed(spark, base)
    return shown_rows(found.withColumn("file_date", F.col("file_date").cast("string")), "created_at").withColumn(
        "tags", F.array_join("tags", "|")
    )


def written_log(spark: SparkSession, sf_dir: str) -> str:
    """The fixture log appended commit by commit."""
    base = workdir.fresh(spark, "log")
    log = X.log(spark, sf_dir).withColumns(
        {
            "cdc_ts": F.col("cdc_ts").cast("timestamp"),
            "cdc_timestamp": F.col("cdc_ts").cast("string"),
            "cdc_seq": F.lit(0).cast("bigint"),
        }
    )
    for commit_id in COMMITS:
        log_sink.append_log(log.filter(F.col("commit_id") == commit_id), base, "expenses", commit_id)
        log_sink.write_commit(spark, base, commit_id, {})
    return base


COMMITS = (1, 2, 3, 4)


def replayed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written log after one commit was delivered a second time."""
    base = written_log(spark, sf_dir)
    again = lake.read_log(spark, base).filter(F.col("commit_id") == 2).drop("commit_id")
    copy = workdir.fresh(spark, "replay")
    again.write.parquet(copy)
    log_sink.append_log(spark.read.parquet(copy), base, "expenses", 2)
    return lake.read_log(spark, base)


def text_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows appended to an all-text catalog table."""
    database = new_database(spark)
    (table,) = ddl.ensure_tables(spark, database, tables=["order"])
    orders = X.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("o_id"),
        (F.col("o_orderkey") % 10 + 1).alias("o_d_id"),
        F.lit(1).alias("o_w_id"),
        F.col("o_custkey").alias("o_c_id"),
        F.col("o_orderdate").alias("o_entry_d"),
        F.lit("").alias("o_carrier_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("o_ol_cnt"),
        (F.col("o_orderkey") % 2 == 0).alias("o_all_local"),
        F.lit("order").alias("cdc_table"),
        F.lit("snapshot").alias("cdc_operation"),
        F.lit(INGEST_TS).alias("cdc_timestamp"),
    )
    log_sink.append_table(orders, table)
    return spark.table(table)


def new_database(spark: SparkSession) -> str:
    name = f"changelake_{uuid.uuid4().hex}"
    ddl.create_database(spark, name, workdir.fresh(spark, "database"))
    return name


def snapshot_table(spark: SparkSession) -> str:
    return f"`{new_database(spark)}`.`expenses_snapshot`"


def snapshot_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_sink.materialize_snapshot(X.live(spark, sf_dir), snapshot_table(spark), FIRST_STAMP)


def snapshot_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of the first images, replaced by one of the live table."""
    table = snapshot_table(spark)
    snapshot_sink.materialize_snapshot(X.first_live(spark, sf_dir), table, FIRST_STAMP)
    return snapshot_sink.materialize_snapshot(X.live(spark, sf_dir), table, SECOND_STAMP)


def snapshot_category_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First images everywhere, the live table in one category."""
    table = snapshot_table(spark)
    snapshot_sink.materialize_snapshot(X.first_live(spark, sf_dir), table, FIRST_STAMP)
    fresh = X.live(spark, sf_dir).filter(F.col("shopping_type") == "1-URGENT")
    return snapshot_sink.refresh_categories(fresh, table, SECOND_STAMP)


def snapshot_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two generations in one table: first images, then the live table."""
    table = snapshot_table(spark)
    snapshot_sink.materialize_snapshot(X.first_live(spark, sf_dir), table, FIRST_STAMP)
    return snapshot_sink.materialize_snapshot(X.live(spark, sf_dir), table, SECOND_STAMP, mode="append")


# -- streams -----------------------------------------------------------------


def landed_stream(spark: SparkSession, sf_dir: str) -> str:
    """Land the before/after feed as text files, one set per change number."""
    landing, base = workdir.fresh(spark, "landing"), workdir.fresh(spark, "stream")
    feed = X.spread(X.changes(spark, sf_dir)).select("seq", EF.pair_event(F.col("seq"), X.change_time()).alias("value"))
    feed.write.partitionBy("seq").text(landing)
    files = catalog.list_output(spark, landing, n=1, pattern="*.txt").first()["total_files"]
    stream = event_files.stream_events(spark, landing, max_files=max(1, -(-files // 3)))
    ingest.run_available(stream, base, ingest_ts=INGEST_TS)
    return base


def streamed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_rows(lake.read_log(spark, landed_stream(spark, sf_dir)), "commit_id")


def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the log, and rows the commit summaries claim."""
    base = landed_stream(spark, sf_dir)
    claimed = lake.read_commits(spark, base).agg(F.sum(F.col("summary")["expenses"].cast("bigint")).alias("n")).scalar()
    counted = stats.stats(lake.read_log(spark, base), lake.read_commits(spark, base))
    return counted.select("total_events", claimed.alias("committed_events"), (F.col("total_flushes") > 1).alias("several_commits"))


# -- a mixed feed, landed in two commits --------------------------------------------


def mixed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bare row per order, received on the first day of its year.

    Rows of a registered all-text table, of a table nobody registered, and expenses.
    """
    kind = F.col("o_orderkey") % 3
    orders = X.over_cores(X.table(spark, sf_dir, "orders"))
    warehouse = F.struct(F.col("o_orderkey").alias("w_id"), F.col("o_orderstatus").alias("w_name"), F.col("o_orderpriority").alias("w_manager"))
    misc = F.struct(F.lit("misc").alias("__table__"), F.col("o_orderkey").alias("k"))
    category = F.when(F.col("o_orderkey") % 7 == 0, F.lit("")).otherwise(F.col("o_orderpriority"))
    expense = F.struct(
        F.col("o_orderkey").cast("string").alias("expense_id"), F.col("o_totalprice").cast("decimal(12,2)").alias("expense_amount"), category.alias("shopping_type")
    )
    value = F.when(kind == 0, F.to_json(warehouse)).when(kind == 1, F.to_json(misc)).otherwise(F.to_json(expense))
    received = F.trunc(F.col("o_orderdate"), "year").cast("timestamp")
    return orders.select("o_orderkey", value.alias("value"), received.alias("received_at"))


def landed_mixed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Log and archive of the mixed feed; the second commit is delivered twice."""
    base, filed = workdir.fresh(spark, "mixed"), workdir.fresh(spark, "mixed-archive")
    feed = mixed_feed(spark, sf_dir)
    for commit_id in (1, 2, 2):
        half = feed.filter(F.col("o_orderkey") % 2 == commit_id - 1)
        ingest.write_batch(half.select("value", "received_at"), base, commit_id, archive=filed)
    return base, filed


def filed_rows(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    base, filed = landed_mixed(spark, sf_dir)
    return lake.read_archive(spark, filed, table, log=base).groupBy(*columns, "year", "month", "day").agg(R.rows().alias("row_count"))


def named_view(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A view of the landed log, by its name."""
    prefix = f"mixed_{uuid.uuid4().hex}_"
    lake.register_log(spark, landed_mixed(spark, sf_dir)[0], prefix)
    return spark.table(prefix + table)


def odd_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change times in five spellings, two of which nobody can read."""
    spelled = F.element_at(F.array(*map(F.lit, ODD_TIMES)), (F.col("o_orderkey") % len(ODD_TIMES) + 1).cast("int"))
    body = F.to_json(F.struct(F.struct(F.col("o_orderkey").cast("string").alias("expense_id")).alias("after"), spelled.alias("updated")))
    rows = N.normalize(X.table(spark, sf_dir, "orders").select(body.alias("value")), INGEST_TS).rows
    return T.typed_rows(rows, "expenses").select("expense_id", F.col("cdc_ts").cast("timestamp_ntz").alias("cdc_ts"))


ODD_TIMES = ("1700000000000000000", "later", "1700000000000", "1700000000000000000.99999999999999999999", "2023-11-14T22:13:20Z")


def sample_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many sampled rows there are, all of them rows of the table."""
    live = X.live(spark, sf_dir)
    return R.sample_rows(live).join(live, live.columns, "left_semi").agg(R.rows().alias("sampled"))


def listing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the listing has as many files as it may, all with bytes."""
    listed = catalog.list_output(spark, archived(spark, sf_dir)[0])
    return listed.agg(
        (F.count("*") == F.least(F.lit(20), F.max("total_files"))).alias("all_listed"), (F.min("length") > 0).alias("all_have_bytes")
    )


def inventory_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = V.file_inventory(lake.read_log(spark, written_log(spark, sf_dir)), "commit_id", "shopping_type")
    return files.groupBy("commit_id", "shopping_type").agg(F.sum("record_count").alias("record_count"), (F.min("file_bytes") > 0).alias("has_bytes"))


# -- row changes ---------------------------------------------------------------

CORRECTION = " (price correction)"


def top_amounts(live: DataFrame, k: int) -> DataFrame:
    return C.pick_top(live, k, F.desc("expense_amount"), F.col(C.KEY))


def corrected(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The five largest amounts raised by 15 percent."""
    assignments = {
        "expense_amount": F.col("expense_amount") * F.lit("1.15").cast("decimal(3,2)"),
        "description": F.concat("description", F.lit(CORRECTION)),
    }
    return C.apply_update(live, top_amounts(live, 5), assignments)


def made_recurring(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The newest 25 one-time expenses of a category become recurring, halved."""
    where = (F.col("shopping_type") == "5-LOW") & ~F.col("recurring")
    pick = C.pick_top(live, 25, F.desc("expense_date"), F.col(C.KEY), where=where)
    half = F.round(F.col("expense_amount") / 2, 2)
    return C.apply_update(live, pick, {"recurring": F.lit(True), "expense_amount": half, "payment_method": F.lit("Apple Pay")})


def smallest_removed(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    return C.apply_delete(live, C.pick_top(live, 3, F.col("expense_amount"), F.col(C.KEY)))


def one_inserted(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One literal row whose user is looked up in the table."""
    user = live.orderBy("user_id").limit(1).select("user_id").scalar()
    given = [("new-1", "Trip", "Demo Merchant", "99.99", "2024-06-01", "Travel", "Credit Card", False)]
    columns = "expense_id string, description string, merchant string, expense_amount string, expense_date string, shopping_type string, payment_method string, recurring boolean"
    return C.apply_insert(live, series.literal_rows(live.sparkSession, given, columns).withColumn("user_id", user))


def event_view(events: DataFrame) -> DataFrame:
    """Events side by side: key, operation, amount before and after."""
    return events.select(
        F.coalesce("after.expense_id", "before.expense_id").alias("expense_id"),
        "cdc_operation",
        R.shown(F.col("before.expense_amount")).alias("amount_before"),
        R.shown(F.col("after.expense_amount")).alias("amount_after"),
    )


def channel_by_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per channel, picked from a list by the key."""
    channels = F.array(F.lit("card"), F.lit("cash"), F.lit("phone"))
    pick = F.element_at(channels, (F.col("o_orderkey") % 3 + 1).cast("int"))
    return X.table(spark, sf_dir, "orders").groupBy(pick.alias("channel")).agg(F.count("*").alias("orders"))


def days_before_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day that lies up to 89 days before their date."""
    day = F.date_sub(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 90).cast("int"))
    return X.table(spark, sf_dir, "orders").groupBy(day.alias("day")).agg(F.count("*").alias("orders"))


def fresh_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random keys for all orders: how many differ, and how many are missing."""
    keys = X.table(spark, sf_dir, "orders").select(F.expr("uuid()").alias("key"))
    return keys.agg(F.countDistinct("key").alias("distinct_keys"), F.count_if(F.col("key").isNull()).alias("missing_keys"))


def register(c: Catalogue) -> None:
    archive_columns = f"""{IMAGE}, cdc_table, CASE WHEN cdc_operation = 'snapshot' THEN 'insert' ELSE cdc_operation END AS cdc_operation, cdc_ts,
strftime(cdc_ts, '%Y') AS year, strftime(cdc_ts, '%m') AS month, '01' AS day"""
    c.add(
        "archive_round_trip",
        lambda s, d: shown_rows(archived(s, d)[1]),
        sql(f"SELECT {archive_columns} FROM cdc"),
    )
    c.add(
        "archive_one_month",
        lambda s, d: shown_rows(archived(s, d)[1].filter("year = '1996' AND month = '03'")),
        sql(f"SELECT * FROM (SELECT {archive_columns} FROM cdc) a WHERE year = '1996' AND month = '03'"),
    )
    c.add("archive_files", lambda s, d: catalog.list_output(s, archived(s, d)[0]).select("path", "length", "total_files"))
    c.add(
        "raw_changefeed",
        raw_round_trip,
        sql(f"""SELECT {IMAGE}, CONCAT(merchant, '|', shopping_type) AS tags, cdc_table,
CASE WHEN cdc_operation = 'snapshot' THEN 'insert' ELSE cdc_operation END AS cdc_operation, cdc_ts,
CASE WHEN commit_id = 1 THEN '2024-01-01' ELSE '2024-01-02' END AS file_date FROM cdc"""),
    )
    log_columns = f"{IMAGE}, cdc_table, cdc_operation, cdc_ts, CAST(commit_id AS BIGINT) AS commit_id"
    c.add("append_round_trip", lambda s, d: shown_rows(replayed_log(s, d)), sql(f"SELECT {log_columns} FROM cdc"))
    c.add(
        "text_table_append",
        lambda s, d: text_table(s, d).drop("o_entry_d"),
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_id, CAST(o_orderkey % 10 + 1 AS VARCHAR) AS o_d_id, '1' AS o_w_id, CAST(o_custkey AS VARCHAR) AS o_c_id,
'' AS o_carrier_id, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_ol_cnt, CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS o_all_local,
'order' AS cdc_table, 'snapshot' AS cdc_operation, '{INGEST_TS}' AS cdc_timestamp FROM orders""",
    )
    c.add("ctas_snapshot", lambda s, d: state_view(snapshot_once(s, d)), sql(f"SELECT {IMAGE}, '{FIRST_STAMP}' AS snapshot_timestamp FROM live"))
    c.add("snapshot_refresh", lambda s, d: state_view(snapshot_refreshed(s, d)), sql(f"SELECT {IMAGE}, '{SECOND_STAMP}' AS snapshot_timestamp FROM live"))
    first_images = "SELECT expense_id, merchant, expense_amount, shopping_type FROM cdc WHERE commit_id = 1"
    c.add(
        "snapshot_partial_refresh",
        lambda s, d: snapshot_category_refreshed(s, d)
        .groupBy("shopping_type", "snapshot_timestamp")
        .agg(R.rows().alias("row_count"), R.total().alias("total_spend")),
        sql(f"""SELECT shopping_type, stamp AS snapshot_timestamp, COUNT(*) AS row_count, CAST(SUM(expense_amount) AS DOUBLE) AS total_spend FROM (
  SELECT shopping_type, expense_amount, '{FIRST_STAMP}' AS stamp FROM ({first_images}) f WHERE shopping_type <> '1-URGENT'
  UNION ALL SELECT shopping_type, expense_amount, '{SECOND_STAMP}' FROM live WHERE shopping_type = '1-URGENT') t GROUP BY shopping_type, stamp"""),
    )
    c.add(
        "snapshot_append",
        lambda s, d: V.compare_generations(snapshot_twice(s, d)),
        sql(f"""SELECT stamp AS snapshot_timestamp, COUNT(*) AS row_count, CAST(SUM(expense_amount) AS DOUBLE) AS total_spend FROM (
  SELECT expense_amount, '{FIRST_STAMP}' AS stamp FROM ({first_images}) f UNION ALL SELECT expense_amount, '{SECOND_STAMP}' FROM live) t GROUP BY stamp"""),
    )
    c.add(
        "snapshot_generations",
        lambda s, d: V.compare_generations(X.snapshots(s, d)),
        sql("SELECT snapshot_timestamp, COUNT(*) AS row_count, CAST(SUM(expense_amount) AS DOUBLE) AS total_spend FROM snap GROUP BY snapshot_timestamp ORDER BY snapshot_timestamp DESC"),
    )

    c.add("stream_to_log", streamed_log, PAIR_LOG)
    c.add(
        "stream_stats",
        stream_counters,
        sql("SELECT COUNT(*) AS total_events, COUNT(*) AS committed_events, TRUE AS several_commits FROM cdc"),
    )

    # -- the mixed feed -----------------------------------------------------
    c.add(
        "generic_rest_members",
        lambda s, d: lake.read_log(s, landed_mixed(s, d)[0], "warehouse").select("w_id", "w_name", "w_city", F.map_keys("rest").alias("names"), F.col("rest")["w_manager"].alias("w_manager")).withColumn("names", F.array_join("names", "|")),
        "SELECT CAST(o_orderkey AS VARCHAR) AS w_id, o_orderstatus AS w_name, '' AS w_city, 'w_manager' AS names, o_orderpriority AS w_manager FROM orders WHERE o_orderkey % 3 = 0",
    )
    filed = "CAST(year(o_orderdate) AS VARCHAR) AS year, '01' AS month, '01' AS day, COUNT(*) AS row_count FROM orders"
    c.add("archive_unregistered", lambda s, d: filed_rows(s, d, lake.OTHER, "cdc_table"), f"SELECT 'misc' AS cdc_table, {filed} WHERE o_orderkey % 3 = 1 GROUP BY year(o_orderdate)")
    c.add("archive_after_replay", lambda s, d: filed_rows(s, d, "expenses"), f"SELECT {filed} WHERE o_orderkey % 3 = 2 GROUP BY year(o_orderdate)")
    c.add(
        "ingest_counters",
        lambda s, d: stats.ingest_counts(lake.read_commits(s, landed_mixed(s, d)[0])),
        "SELECT CAST(2 AS BIGINT) AS batches, COUNT(*) AS events, COUNT(*) FILTER (o_orderkey % 2 = 1) AS events_in_last_batch FROM orders",
    )
    category = "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END"
    c.add(
        "empty_category_round_trip",
        lambda s, d: lake.read_log(s, landed_mixed(s, d)[0]).select("expense_id", "shopping_type"),
        f"SELECT CAST(o_orderkey AS VARCHAR) AS expense_id, {category} AS shopping_type FROM orders WHERE o_orderkey % 3 = 2",
    )
    c.add(
        "named_log_spending",
        lambda s, d: R.spending_by(named_view(s, d, "expenses"), "shopping_type"),
        f"SELECT {category} AS shopping_type, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_spend, COUNT(*) AS txn_count FROM orders WHERE o_orderkey % 3 = 2 GROUP BY 1",
    )
    c.add(
        "named_log_commits",
        lambda s, d: V.list_commits(named_view(s, d, "commits")).select("commit_id", "parent_id", "operation", F.col("summary")["expenses"].cast("bigint").alias("expenses")),
        """SELECT o_orderkey % 2 + 1 AS commit_id, CASE WHEN o_orderkey % 2 = 1 THEN CAST(1 AS BIGINT) END AS parent_id, 'append' AS operation, COUNT(*) AS expenses
FROM orders WHERE o_orderkey % 3 = 2 GROUP BY o_orderkey % 2""",
    )
    c.add(
        "odd_times",
        odd_times,
        "SELECT CAST(o_orderkey AS VARCHAR) AS expense_id, CASE WHEN o_orderkey % 5 < 2 THEN TIMESTAMP '2024-06-01 00:00:00' ELSE TIMESTAMP '2023-11-14 22:13:20' END AS cdc_ts FROM orders",
    )
    c.add("live_sample_summary", sample_summary, sql("SELECT LEAST(5, COUNT(*)) AS sampled FROM live"))
    c.add("archive_files_summary", listing_summary, sql("SELECT COUNT(*) > 0 AS all_listed, COUNT(*) > 0 AS all_have_bytes FROM cdc"))
    c.add(
        "file_inventory_summary",
        inventory_summary,
        sql("SELECT CAST(commit_id AS BIGINT) AS commit_id, shopping_type, COUNT(*) AS record_count, TRUE AS has_bytes FROM cdc GROUP BY commit_id, shopping_type"),
    )

    # -- versions ---------------------------------------------------------
    c.add("log_as_of", lambda s, d: state_view(V.as_of(X.log(s, d), 2)), sql(f"SELECT {IMAGE}, cdc_table, cdc_operation, cdc_ts, commit_id FROM cdc WHERE commit_id <= 2"))
    c.add(
        "log_as_of_written",
        lambda s, d: shown_rows(V.as_of(lake.read_log(s, written_log(s, d)), 2)),
        sql(f"SELECT {log_columns} FROM cdc WHERE commit_id <= 2"),
    )
    c.add(
        "commit_list",
        lambda s, d: V.list_commits(X.commits(s, d)).select(
            "commit_id", "parent_id", "operation", "committed_at", F.col("summary")["added_rows"].cast("bigint").alias("added_rows")
        ),
        sql("SELECT commit_id, parent_id, operation, committed_at, added_rows FROM commits ORDER BY committed_at DESC"),
    )
    c.add(
        "commit_list_newest",
        lambda s, d: V.list_commits(X.commits(s, d), 2).select("commit_id", "committed_at", "operation"),
        sql("SELECT commit_id, committed_at, operation FROM commits ORDER BY committed_at DESC LIMIT 2"),
    )
    c.add(
        "commit_history",
        lambda s, d: V.history(X.commits(s, d)),
        sql("SELECT committed_at AS made_current_at, commit_id, parent_id, commit_id = (SELECT MAX(commit_id) FROM commits) AS is_current FROM commits"),
    )
    c.add(
        "partition_stats",
        lambda s, d: V.partition_stats(lake.read_log(s, written_log(s, d)), "shopping_type").select("shopping_type", "record_count"),
        sql("SELECT shopping_type, COUNT(*) AS record_count FROM cdc GROUP BY shopping_type"),
    )
    c.add(
        "files_per_commit",
        lambda s, d: V.files_per_commit(lake.read_log(s, written_log(s, d))).select("commit_id", "record_count", (F.col("file_count") > 0).alias("has_files")),
        sql("SELECT CAST(commit_id AS BIGINT) AS commit_id, COUNT(*) AS record_count, TRUE AS has_files FROM cdc GROUP BY commit_id"),
    )
    c.add("file_inventory", lambda s, d: V.file_inventory(lake.read_log(s, written_log(s, d)), "commit_id", "shopping_type"))

    # -- row changes ------------------------------------------------------
    picked = "SELECT expense_id FROM live ORDER BY expense_amount DESC, expense_id LIMIT 5"
    c.add(
        "apply_update_topk",
        lambda s, d: state_view(corrected(X.live(s, d))[0]),
        sql(f"""SELECT expense_id, user_id, CASE WHEN hit THEN CONCAT(description, '{CORRECTION}') ELSE description END AS description, merchant,
CAST(CASE WHEN hit THEN CAST(expense_amount * 1.15 AS DECIMAL(12,2)) ELSE expense_amount END AS DOUBLE) AS expense_amount,
expense_date, shopping_type, payment_method, recurring FROM (SELECT *, expense_id IN ({picked}) AS hit FROM live) t"""),
    )
    c.add(
        "apply_update_events",
        lambda s, d: event_view(corrected(X.live(s, d))[1]),
        sql(f"""SELECT expense_id, 'update' AS cdc_operation, CAST(expense_amount AS DOUBLE) AS amount_before,
CAST(CAST(expense_amount * 1.15 AS DECIMAL(12,2)) AS DOUBLE) AS amount_after FROM live WHERE expense_id IN ({picked})"""),
    )
    newest = "SELECT expense_id FROM live WHERE shopping_type = '5-LOW' AND NOT recurring ORDER BY expense_date DESC, expense_id LIMIT 25"
    c.add(
        "apply_update_category",
        lambda s, d: state_view(made_recurring(X.live(s, d))[0]),
        sql(f"""SELECT expense_id, user_id, description, merchant,
CAST(CASE WHEN hit THEN ROUND(CAST(expense_amount * 0.5 AS DECIMAL(14,3)), 2) ELSE expense_amount END AS DOUBLE) AS expense_amount, expense_date, shopping_type,
CASE WHEN hit THEN 'Apple Pay' ELSE payment_method END AS payment_method, (hit OR recurring) AS recurring
FROM (SELECT *, expense_id IN ({newest}) AS hit FROM live) t"""),
    )
    smallest = "SELECT expense_id FROM live ORDER BY expense_amount, expense_id LIMIT 3"
    c.add(
        "apply_delete_topk",
        lambda s, d: state_view(smallest_removed(X.live(s, d))[0]),
        sql(f"SELECT {IMAGE} FROM live WHERE expense_id NOT IN ({smallest})"),
    )
    c.add(
        "apply_delete_events",
        lambda s, d: event_view(smallest_removed(X.live(s, d))[1]),
        sql(f"SELECT expense_id, 'delete' AS cdc_operation, CAST(expense_amount AS DOUBLE) AS amount_before, CAST(NULL AS DOUBLE) AS amount_after FROM live WHERE expense_id IN ({smallest})"),
    )
    c.add(
        "apply_insert",
        lambda s, d: state_view(one_inserted(X.live(s, d))[0]),
        sql(f"""SELECT {IMAGE} FROM live UNION ALL SELECT 'new-1', (SELECT MIN(user_id) FROM live), 'Trip', 'Demo Merchant', 99.99, '2024-06-01', 'Travel', 'Credit Card', FALSE"""),
    )
    c.add("channel_by_turn", channel_by_turn, "SELECT (['card', 'cash', 'phone'])[o_orderkey % 3 + 1] AS channel, COUNT(*) AS orders FROM orders GROUP BY 1")
    c.add(
        "days_before_order",
        days_before_order,
        "SELECT CAST(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 90 AS INTEGER) AS DATE) AS day, COUNT(*) AS orders FROM orders GROUP BY 1",
    )
    c.add("fresh_keys", fresh_keys, "SELECT COUNT(*) AS distinct_keys, CAST(0 AS BIGINT) AS missing_keys FROM orders")
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM t_{t}" for t in ORDER_ENTRY_MEMBERS)
    c.add("tpcc_table_row_counts", lambda s, d: catalog.named_row_counts(**X.order_entry(s, d)), order_sql(counts))
    assert set(ORDER_ENTRY_MEMBERS) == set(REGISTRY) - {"expenses"}
