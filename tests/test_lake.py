"""Sources, sinks, catalog tables and row changes on small tables."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changelake import workdir
from changelake.operators import changes as C
from changelake.operators import envelope as N
from changelake.operators import reports as R
from changelake.operators import shaping as T
from changelake.operators import state as S
from changelake.schemas import RAW_BEFORE, RAW_EVENT_TYPE, RAW_UPDATED, REGISTRY
from changelake.sinks import archive, ddl
from changelake.sinks import log as log_sink
from changelake.sinks import snapshot
from changelake.sources import catalog, events, jdbc, lake
from changelake.sources import raw_changefeed as raw
from changelake.sources import series

COLUMNS = "expense_id string, user_id string, description string, merchant string, expense_amount decimal(12,2), expense_date string, shopping_type string, payment_method string, recurring boolean"


def expense(key, amount, kind="Food", recurring=False):
    return (key, "u", f"row {key}", "m", Decimal(str(amount)), "2024-01-01", kind, "Card", recurring)


@pytest.fixture
def live(spark):
    return spark.createDataFrame([expense("a", 1), expense("b", 5.55), expense("c", 3, "Fuel"), expense("d", 4)], COLUMNS)


def amounts(df):
    return {r.expense_id: float(r.expense_amount) for r in df.collect()}


# -- row changes ---------------------------------------------------------------


def test_update(spark, live):
    pick = C.pick_top(live, 2, F.desc("expense_amount"), F.col("expense_id"))
    new, changed = C.apply_update(live, pick, {"expense_amount": F.col("expense_amount") * F.lit("1.15").cast("decimal(3,2)")})
    assert amounts(new) == {"a": 1.0, "b": 6.38, "c": 3.0, "d": 4.6}
    assert new.schema.simpleString() == live.schema.simpleString()
    assert {(r.before.expense_id, float(r.before.expense_amount), float(r.after.expense_amount)) for r in changed.collect()} == {
        ("b", 5.55, 6.38),
        ("d", 4.0, 4.6),
    }


def test_changes_then_fold_is_the_new_table(spark, live):
    after_update, updates = C.apply_update(live, C.pick_top(live, 1, F.col("expense_id")), {"merchant": F.lit("n")})
    after_delete, deletes = C.apply_delete(after_update, C.pick_top(after_update, 2, F.desc("expense_id")))
    rows = series.literal_rows(spark, [expense("e", 9)], COLUMNS)
    after_insert, inserts = C.apply_insert(after_delete, rows)
    log = None
    for n, part in enumerate((updates, deletes, inserts)):
        piece = C.log_rows(part, F.lit(datetime(2024, 1, n + 1))).withColumn("commit_id", F.lit(n))
        log = piece if log is None else log.unionByName(piece)
    folded = S.fold(live, log, ["expense_id"], ["cdc_ts", "commit_id"])
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, after_insert.select(folded.columns).collect()))


def test_equal_times_are_settled_by_operation(spark):
    rows = [("a", Decimal("1"), "insert", 1), ("a", Decimal("2"), "update", 1), ("b", Decimal("1"), "insert", 1), ("b", Decimal("1"), "delete", 1)]
    log = spark.createDataFrame(rows, "expense_id string, expense_amount decimal(12,2), cdc_operation string, cdc_ts long")
    assert amounts(S.current_state(log, ["expense_id"], ["cdc_ts"])) == {"a": 2.0}
    assert S.current_state_maxjoin(log, ["expense_id"]).count() == 3


def test_unknown_operations_are_left_out_of_spending(spark):
    log = spark.createDataFrame([("x", Decimal("1"), None), ("x", Decimal("2"), "insert")], "merchant string, expense_amount decimal(12,2), cdc_operation string")
    assert R.spending_by(log, "merchant").first().txn_count == 1


# -- files -----------------------------------------------------------------------


def test_list_and_read_landing_files(spark, tmp_path):
    (tmp_path / "one.txt").write_text(json.dumps({"expense_id": "x"}) + "\n")
    feed = events.read_events(spark, str(tmp_path), feed="mine")
    assert N.normalize(feed, "t").rows.first().feed == "mine"
    (listed,) = catalog.list_output(spark, str(tmp_path), pattern="*.txt").collect()
    assert listed.path.endswith("one.txt") and listed.total_files == 1


def log_of(spark, live):
    return live.select(
        "*",
        F.lit("expenses").alias("cdc_table"),
        F.lit("insert").alias("cdc_operation"),
        F.lit("2024-03-05T10:00:00Z").alias("cdc_timestamp"),
        F.lit(datetime(2024, 3, 5, 10)).alias("cdc_ts"),
        F.lit(0).cast("long").alias("cdc_seq"),
    )


def test_archive_layout_and_pruning(spark, live, tmp_path):
    base = str(tmp_path)
    path = archive.write_archive(log_of(spark, live), base, "expenses", date=F.col("cdc_ts"))
    assert (tmp_path / "spending/expenses/year=2024/month=03/day=05").is_dir()
    assert path == f"{base}/spending/expenses"
    back = lake.read_archive(spark, base)
    assert back.filter("month = '03'").count() == 4 and back.filter("month = '04'").count() == 0
    plan = back.filter("month = '04'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_archive_defaults_to_the_day_of_the_job(spark, live, tmp_path):
    archive.write_archive(log_of(spark, live), str(tmp_path), "expenses")
    today = spark.sql("select date_format(current_date(), 'yyyy')").first()[0]
    assert (tmp_path / f"spending/expenses/year={today}").is_dir()


def test_raw_changefeed_skips_markers_and_fills_deletes(spark, tmp_path):
    day = tmp_path / "2024-02-03"
    rows = [
        ("a", Decimal("1.50"), "c", "1000000000.0000000000", None),
        ("a", None, "d", "2000000000.0000000000", '{"expense_id":"a","expense_amount":1.5,"merchant":"m"}'),
    ]
    columns = f"expense_id string, expense_amount decimal(12,2), {RAW_EVENT_TYPE} string, {RAW_UPDATED} string, {RAW_BEFORE} string"
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(str(day))
    (day / "20240203.RESOLVED").write_text("marker")
    found = sorted(raw.read_raw_changefeed(spark, str(tmp_path)).collect(), key=lambda r: r.cdc_ts)
    assert [r.cdc_operation for r in found] == ["insert", "delete"]
    assert found[1].expense_amount == Decimal("1.50") and found[1].merchant == "m"
    assert str(found[0].file_date) == "2024-02-03"


def test_raw_changefeed_whose_oldest_day_lacks_columns(spark, tmp_path):
    meta = f"{RAW_EVENT_TYPE} string, {RAW_UPDATED} string"
    spark.createDataFrame([("a", "c", "1000000000.0000000000")], f"expense_id string, {meta}").write.parquet(str(tmp_path / "2024-02-03"))
    gone = [("a", None, "d", "2000000000.0000000000", '{"expense_id":"a","merchant":"m"}')]
    spark.createDataFrame(gone, f"expense_id string, shopping_type string, {meta}, {RAW_BEFORE} string").write.parquet(str(tmp_path / "2024-02-04"))
    found = {r.cdc_operation: r.merchant for r in raw.read_raw_changefeed(spark, str(tmp_path)).collect()}
    assert found == {"insert": None, "delete": "m"}


def test_no_files_yet_is_an_empty_log(spark, tmp_path):
    assert lake.read_log(spark, str(tmp_path / "nothing")).count() == 0


# -- catalog ---------------------------------------------------------------------


def test_ddl_append_and_reset(spark, live, tmp_path):
    names = ddl.ensure_tables(spark, "changelake_ddl", str(tmp_path / "db"))
    assert len(names) == len(REGISTRY)
    ddl.ensure_tables(spark, "changelake_ddl")  # a second time changes nothing
    listed = {r.table_name for r in catalog.list_tables(spark, "changelake_ddl").collect()}
    assert listed == set(REGISTRY)
    rows = log_of(spark, live)
    log_sink.append_table(rows, "changelake_ddl.expenses")
    log_sink.append_table(rows, "changelake_ddl.expenses")
    assert spark.table("changelake_ddl.expenses").count() == 8
    snapshot.materialize_snapshot(live, f"changelake_ddl.{ddl.SNAPSHOT_TABLE}", "t1")
    assert [r.row_count for r in ddl.reset_tables(spark, "changelake_ddl", ["expenses", "order"]).collect()] == [0, 0]
    assert not spark.catalog.tableExists(f"changelake_ddl.{ddl.SNAPSHOT_TABLE}")
    assert any(r[0] == "spark_catalog" for r in catalog.list_catalogs(spark).collect())
    assert any(r[0] == "changelake_ddl" for r in catalog.list_databases(spark).collect())


def test_snapshot_table_is_partitioned(spark, live, tmp_path):
    ddl.create_database(spark, "changelake_snap", str(tmp_path / "db"))
    table = snapshot.materialize_snapshot(live, "changelake_snap.s")
    assert table.count() == 4 and table.filter(F.col("snapshot_timestamp").isNull()).count() == 0
    plan = table.filter("shopping_type = 'Fuel'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shopping_type" in plan
    assert snapshot.materialize_snapshot(live, "changelake_snap.s", "t2", mode="append").count() == 8
    assert snapshot.materialize_snapshot(live, "changelake_snap.s", "t3").count() == 4


# -- JDBC options (no database is started here) -----------------------------------


def test_jdbc_options():
    chosen = jdbc.options("jdbc:x", "public.expenses", "expense_date", "2024-01-01", "2025-01-01", 16, driver="d")
    assert chosen["numPartitions"] == "16" and chosen["lowerBound"] == "2024-01-01" and chosen["driver"] == "d"
    assert "partitionColumn" not in jdbc.options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc.options("jdbc:x", "t", partition_column="expense_date")


def test_live_columns_are_cast_once(spark):
    wide = spark.range(1).select(
        F.col("id").alias("expense_id"),
        F.lit(1).alias("user_id"),
        F.lit("d").alias("description"),
        F.lit("m").alias("merchant"),
        F.lit(1.5).alias("expense_amount"),
        F.lit("2024-01-01").cast("date").alias("expense_date"),
        F.lit("k").alias("shopping_type"),
        F.lit("p").alias("payment_method"),
        F.lit(True).alias("recurring"),
        F.array(F.lit(0.1)).alias("embedding"),
    )
    row = jdbc.as_registered(wide, REGISTRY["expenses"]).first()
    assert row.asDict() == {
        "expense_id": "0", "user_id": "1", "description": "d", "merchant": "m", "expense_amount": Decimal("1.50"),
        "expense_date": "2024-01-01", "shopping_type": "k", "payment_method": "p", "recurring": True,
    }


# -- generated rows, shared folder, bounds ---------------------------------------


def test_series(spark):
    assert [r.g for r in series.series(spark, 3).collect()] == [1, 2, 3]


def test_shared_folder_comes_from_the_session(spark):
    assert workdir.fresh(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert workdir.fresh(spark, "x") != workdir.fresh(spark, "x")


def test_fill_defaults_and_all_strings(spark):
    df = spark.createDataFrame([(None, None, None)], "expense_id string, expense_amount decimal(12,2), recurring boolean")
    assert tuple(T.fill_defaults(df, "expenses").first()) == ("", Decimal("0.00"), False)
    assert tuple(T.all_strings(spark.range(1)).first()) == ("0",)
