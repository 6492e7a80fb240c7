"""Plan shapes and hot keys: what has to hold at a thousand times the data."""

import re
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changelake.operators import hybrid as H
from changelake.operators import reports as R
from changelake.operators import state as S
from changelake.operators import versions as V
from changelake.plans import fixtures as X
from changelake.sinks import archive
from changelake.sinks import log as log_sink
from changelake.sources import lake

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def fixture(spark):
    return X.live(spark, SF_DIR), X.log(spark, SF_DIR), X.snapshots(spark, SF_DIR)


HOT_ROWS, OTHER_KEYS = 4000, 2000
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A stored log in which one key has two thirds of the rows."""
    columns = "expense_id string, user_id string, description string, merchant string, expense_amount decimal(12,2), expense_date string, shopping_type string, payment_method string, recurring boolean, cdc_table string, cdc_operation string, cdc_timestamp string, cdc_ts timestamp, cdc_seq long"

    def row(key, i, op):
        return (key, "u", "d", "m", Decimal(i % 97), "2024-01-01", "Hot" if key == "hot" else "Cold", "p", False, "expenses", op, "t", START + timedelta(seconds=i), 0)

    rows = [row("hot", i, "insert" if i == 0 else "update") for i in range(HOT_ROWS)]
    rows += [row(f"k{i}", i, "insert") for i in range(OTHER_KEYS)]
    base = str(tmp_path_factory.mktemp("hot"))
    log_sink.append_log(spark.createDataFrame(rows, columns).repartition(16), base, "expenses", 1)
    log_sink.write_commit(spark, base, 1, {"expenses": len(rows)})
    return base


def live_of(log):
    return S.fold(None, log.drop("cdc_seq"), ["expense_id"], ["cdc_ts", "commit_id"])


def with_conf(spark, settings):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)

    def undo():
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)

    return undo


def test_hot_key_join_is_split(spark, hot, tmp_path):
    log = lake.read_log(spark, hot)
    live_of(log).write.parquet(str(tmp_path / "live"))
    live = spark.read.parquet(str(tmp_path / "live"))
    undo = with_conf(
        spark,
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        },
    )
    try:
        history = H.live_with_history(live, log, n=HOT_ROWS + OTHER_KEYS)
        assert "skew=true" in final_plan(history)
        assert Counter(r.expense_id == "hot" for r in history.collect()) == {True: HOT_ROWS, False: OTHER_KEYS}
    finally:
        undo()


def test_hot_key_state_is_reduced_before_the_shuffle(spark, hot):
    state = S.current_state(lake.read_log(spark, hot), ["expense_id"], ["cdc_ts", "commit_id"])
    rows = {r.expense_id: r.cdc_ts for r in state.select("expense_id", "cdc_ts").collect()}
    assert len(rows) == OTHER_KEYS + 1 and rows["hot"] == START + timedelta(seconds=HOT_ROWS - 1)
    shape = plan(state)
    assert shape.index("partial_max") > shape.index("Exchange hashpartitioning(expense_id")


def test_a_large_day_is_written_by_several_tasks(spark, hot, tmp_path):
    undo = with_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB"})
    try:
        archive.write_archive(lake.read_log(spark, hot), str(tmp_path), "expenses", date=F.lit("2024-03-05").cast("date"))
    finally:
        undo()
    files = list((tmp_path / "spending/expenses/year=2024/month=03/day=05").glob("**/*.parquet"))
    assert len(files) > 1
    assert lake.read_archive(spark, str(tmp_path)).count() == HOT_ROWS + OTHER_KEYS


def test_audit_of_hot_key_keeps_every_row(spark, hot):
    log = lake.read_log(spark, hot)
    assert S.most_modified_audit(log, 1).count() == HOT_ROWS
    assert R.audit_trail(log, "hot").count() == HOT_ROWS
    assert {(r.expense_id, r.total_changes) for r in H.modification_audit(live_of(log), log).collect()} == {("hot", HOT_ROWS)}


def test_key_lookup_reaches_the_scan(spark, hot):
    trail = R.audit_trail(lake.read_log(spark, hot), "k7")
    assert "EqualTo(expense_id,k7)" in plan(trail)
    assert trail.count() == 1


def test_category_filter_prunes_folders(spark, hot):
    log = lake.read_log(spark, hot).filter(F.col("shopping_type") == "Cold")
    assert log.count() == OTHER_KEYS
    assert "isnotnull(shopping_type" in plan(log) and "PartitionFilters" in plan(log)


def test_partition_stats_read_no_columns(spark, hot):
    log = lake.read_log(spark, hot)
    stats = V.partition_stats(log, "shopping_type")
    assert {r.shopping_type: r.record_count for r in stats.collect()} == {"Hot": HOT_ROWS, "Cold": OTHER_KEYS}
    assert "ReadSchema: struct<>" in plan(stats)
    assert all(r.file_bytes > 0 for r in V.file_inventory(log, "commit_id").collect())


def test_ghosts_are_an_anti_join(fixture):
    live, log, _ = fixture
    assert "LeftAnti" in plan(H.ghost_records(log, live))


def test_top_k_never_sorts_everything(fixture):
    live, log, _ = fixture
    for df in (R.recent_changes(log), H.live_with_history(live, log), H.changed_amounts(live, log), H.price_drift(live, log)):
        assert "TakeOrderedAndProject" in plan(df)
        assert "rangepartitioning" not in plan(df)


def test_lifecycle_aggregates_the_log_once(fixture):
    live, log, snap = fixture
    assert final_plan(H.full_lifecycle(log, live, snap)).count("ReusedSubquery") >= 2


def test_lifecycle_has_one_plan_whatever_its_length(fixture):
    live, log, snap = fixture
    few, many = (H.full_lifecycle(log, live, snap, n) for n in (50, 5000))
    shape = lambda df: re.findall(r"\b[A-Z]\w+(?:Join|Aggregate|Generate|Exchange)\b", plan(df))
    assert shape(few) == shape(many) and "LeftSemi" in plan(few)
    assert set(few.collect()) <= set(many.collect())


def test_state_reads_only_the_columns_asked_for(fixture):
    _, log, _ = fixture
    few = S.current_state(log, ["expense_id"], ["cdc_ts"], ["expense_amount"])
    assert len(re.findall("o_\\w+:", plan(few).split("ReadSchema")[1])) < len(re.findall("o_\\w+:", plan(S.current_state(log, ["expense_id"], ["cdc_ts"])).split("ReadSchema")[1]))


def test_fold_reduces_the_log_once(spark, hot, tmp_path):
    log = lake.read_log(spark, hot)
    live_of(log).write.parquet(str(tmp_path / "base"))
    folded = S.fold(spark.read.parquet(str(tmp_path / "base")), log.drop("cdc_seq"), ["expense_id"], ["cdc_ts", "commit_id"])
    assert len(folded.collect()) == OTHER_KEYS + 1
    assert "ReusedExchange" in plan(folded)


def test_small_picks_are_broadcast_without_a_hint(fixture):
    _, log, _ = fixture
    assert "BroadcastHashJoin" in plan(S.most_modified_audit(log, 5))


def test_shares_reuse_the_grouping(fixture):
    _, log, _ = fixture
    share = R.operation_share(log)
    share.collect()
    shape = plan(share)
    assert "Window" not in shape and "ReusedExchange" in shape
    assert abs(sum(r.share_pct for r in R.operation_share(log).collect()) - 100) < 1e-9


def test_reports_read_only_their_columns(fixture):
    _, log, _ = fixture
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan(R.operation_counts(log))


def test_spread_leaves_large_scans_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert "Exchange" in plan(X.spread(spark.range(10, numPartitions=1)))
    assert "Exchange" not in plan(X.spread(spark.range(10, numPartitions=cores)))


def test_counts_add_up(spark, fixture):
    live, log, _ = fixture
    assert sum(r.event_count for r in R.operation_counts(log).collect()) == log.count()
    assert V.as_of(log, 4).count() == log.count()
    folded = S.fold(None, log, ["expense_id"], ["cdc_ts", "commit_id"])
    assert folded.exceptAll(live).count() == 0 and live.exceptAll(folded).count() == 0
