"""What has to stay in proportion when the tables grow: passes, lookups, rows of one task."""

import json

from pyspark.sql import functions as F

from changelake.operators import envelope as N
from changelake.plans import fixtures as X
from changelake.plans import lake_queries as L
from changelake.plans import upkeep_queries as U
from changelake.sinks import catalog_log
from changelake.sinks import log as log_sink

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counting_tables_derives_no_times_and_no_bodies(spark):
    feed = spark.createDataFrame([(json.dumps({"expense_id": "e1"}),)], "value string")
    rows = N.normalize(feed, "2024-06-01T00:00:00Z").rows
    assert "timestamp_micros" not in plan(rows.groupBy("cdc_table").count())
    assert "timestamp_micros" in plan(rows.select("cdc_ts"))


def test_members_are_read_in_one_pass_per_object(spark):
    feed = spark.createDataFrame([(json.dumps({"after": {"expense_id": "e1"}}),)], "value string")
    counted = N.normalize(feed, "2024-06-01T00:00:00Z").rows.groupBy("cdc_table").count()
    assert plan(counted).count("try_variant_get(") <= 20  # 59 with a lookup per member


def test_one_input_task_of_one_folder_is_dealt_over_several(spark):
    rows = spark.range(200_000).coalesce(1).select(F.col("id").cast("string").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("a").alias("folder"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1m")
    try:
        dealt = log_sink.rebalanced(rows, ("folder",), ("k",)).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("v"), F.max("k")).collect()
    finally:
        spark.conf.set(name, before)
    assert sum(r["n"] for r in dealt) == 200_000
    assert max(r["n"] for r in dealt) < 100_000


def test_rows_without_keys_are_rebalanced_whole(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "a"), ("1", None)], "k string, folder string")
    assert sorted(log_sink.rebalanced(rows, ("folder",), ("k",)).collect(), key=str) == sorted(rows.collect(), key=str)


def test_a_feed_of_one_row_group_is_dealt_over_tasks(spark):
    assert "REBALANCE_PARTITIONS_BY_NONE" in plan(X.spread(X.table(spark, SF_DIR, "orders")))
    assert "REPARTITION_BY_NUM" in plan(L.mixed_feed(spark, SF_DIR))


def test_commits_are_appended_from_rows_normalized_once(spark, monkeypatch):
    appended = []
    kept = catalog_log.append_commit
    monkeypatch.setattr(catalog_log, "append_commit", lambda df, *rest: (appended.append(plan(df)), kept(df, *rest)))
    U.appended_twice(spark, SF_DIR).collect()
    assert len(appended) == 3
    assert not any("parseJson" in p for p in appended)
