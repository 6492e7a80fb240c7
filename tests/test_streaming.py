"""Streaming ingest: batches, restart, replay, failure, versions."""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from changelake.operators import versions as V
from changelake.sinks import archive
from changelake.sources import events, lake
from changelake.streaming import ingest, stats

INGEST = "2024-06-01T00:00:00+00:00"


def event(key, amount, before=None, removed=False, at=1):
    row = {"expense_id": key, "merchant": "m", "expense_amount": amount, "shopping_type": "Food"}
    return {"before": row if removed else before, "after": None if removed else row, "updated": f"{at}000000000.0000000000"}


BATCHES = [
    [event("a", 1, at=1), event("b", 2, at=1), {"w_id": 1, "w_name": "north"}],
    [event("a", 3, before={"expense_id": "a"}, at=2), {"resolved": "2000000000.0000000000"}],
    [event("b", 2, removed=True, at=3), "not an event", {"x": 1}],
    [event("c", 9, at=4)],
]


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def land(folder, *numbers):
    for n in numbers:
        (folder / f"batch-{n}.txt").write_text("\n".join(json.dumps(e) for e in BATCHES[n]) + "\n")


def start(spark, landing, base, **more):
    stream = events.stream_events(spark, str(landing), max_files=1)
    return ingest.run_available(stream, base, ingest_ts=INGEST, timeout=120, **more)


def log_keys(spark, base):
    return sorted((r.expense_id, r.cdc_operation, r.commit_id) for r in lake.read_log(spark, base).collect())


def test_commits_restart_and_versions(spark, landing, tmp_path):
    base = str(tmp_path / "lake")
    land(landing, 0, 1, 2)
    start(spark, landing, base)
    assert len(log_keys(spark, base)) == 4
    assert lake.read_commits(spark, base).count() == 3

    start(spark, landing, base)  # nothing new
    assert lake.read_commits(spark, base).count() == 3

    land(landing, 3)
    start(spark, landing, base)
    log, commits = lake.read_log(spark, base), lake.read_commits(spark, base)
    counts = stats.stats(log, commits).first()
    assert (counts.total_events, counts.total_flushes) == (5, 4)
    assert tuple(stats.ingest_counts(commits).first()) == (4, 9, 1)
    assert V.as_of(log, 4).count() == 5
    assert sorted(r.commit_id for r in V.list_commits(commits, 2).collect()) == [3, 4]
    assert [r.commit_id for r in V.history(commits).collect() if r.is_current] == [4]
    assert sum(r.record_count for r in V.files_per_commit(log).collect()) == 5

    assert lake.read_log(spark, base, "warehouse").first().w_name == "north"
    assert lake.read_log(spark, base, "item").count() == 0
    assert lake.read_dead_letters(spark, base).first().reason == "not_an_object"
    assert lake.read_progress(spark, base).first().resolved == "2000000000.0000000000"
    assert json.loads(lake.read_other_rows(spark, base).first().body) == {"x": 1}


def test_a_batch_written_twice_counts_once(spark, tmp_path):
    base = str(tmp_path / "lake")
    batch = spark.createDataFrame([(json.dumps(e),) for e in BATCHES[0]], "value string")
    for _ in range(2):
        assert ingest.write_batch(batch, base, 1, INGEST) == {"expenses": 2, "warehouse": 1}
    assert lake.read_log(spark, base).count() == 2
    assert lake.read_commits(spark, base).count() == 1


def test_an_unlisted_commit_is_not_read(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "lake")
    first, second = (spark.createDataFrame([(json.dumps(e),) for e in BATCHES[n]], "value string") for n in (0, 1))
    ingest.write_batch(first, base, 1, INGEST)

    def fails(*_):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(ingest, "write_commit", fails)
        with pytest.raises(OSError):
            ingest.write_batch(second, base, 2, INGEST)
    assert {k for _, _, k in log_keys(spark, base)} == {1}
    ingest.write_batch(second, base, 2, INGEST)
    assert {k for _, _, k in log_keys(spark, base)} == {1, 2}


def test_a_failed_stream_resumes(spark, landing, tmp_path, monkeypatch):
    base = str(tmp_path / "lake")
    land(landing, 0, 1)
    original = ingest.write_commit

    def fails_on_second(session, where, commit_id, *rest):
        if commit_id == 2:
            raise OSError("no space")
        original(session, where, commit_id, *rest)

    with monkeypatch.context() as m:
        m.setattr(ingest, "write_commit", fails_on_second)
        with pytest.raises(StreamingQueryException):
            start(spark, landing, base)
    assert {k for _, _, k in log_keys(spark, base)} == {1}
    start(spark, landing, base)
    assert log_keys(spark, base) == [("a", "insert", 1), ("a", "update", 2), ("b", "insert", 1)]


def test_drain(spark, landing, tmp_path):
    base = str(tmp_path / "lake")
    land(landing, 0)
    stream = events.stream_events(spark, str(landing), max_files=1)
    query = ingest.run_to_log(stream, base, trigger={"processingTime": "1 second"}, ingest_ts=INGEST)
    ingest.drain(query)
    assert not query.isActive
    assert len(log_keys(spark, base)) == 2


def test_commit_filter_prunes_folders(spark, tmp_path):
    base = str(tmp_path / "lake")
    for n, batch in enumerate(BATCHES, 1):
        ingest.write_batch(spark.createDataFrame([(json.dumps(e),) for e in batch], "value string"), base, n, INGEST)
    log = V.as_of(lake.read_log(spark, base), 1).filter(F.col("shopping_type") == "Food").select("expense_id")
    assert sorted(r.expense_id for r in log.collect()) == ["a", "b"]
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(commit_id" in plan and "commit_id#" in plan
    assert "ReadSchema: struct<expense_id:string>" in plan


def test_archive_beside_the_log(spark, landing, tmp_path):
    base, filed = str(tmp_path / "lake"), str(tmp_path / "archive")
    land(landing, 0, 1)
    start(spark, landing, base, archive=filed)
    batch = spark.createDataFrame([(json.dumps(e),) for e in BATCHES[1]], "value string")
    ingest.write_batch(batch, base, 2, INGEST, filed)  # delivered again
    assert (tmp_path / "archive/spending/expenses/year=1970/month=01/day=01/commit_id=2").is_dir()
    assert sorted(r.expense_id for r in lake.read_archive(spark, filed).collect()) == ["a", "a", "b"]
    assert lake.read_archive(spark, filed, "warehouse").first().w_id == "1"


def test_pending_messages():
    behind = {"endOffset": {"t": {"0": 5, "1": 5}}, "latestOffset": '{"t": {"0": 9, "1": 8, "2": 1}}'}
    assert stats.pending({"sources": [behind, {}]}) == 8
    assert stats.pending({"sources": [{}, {"latestOffset": {"logOffset": 3}}]}) is None


def test_a_lost_checkpoint_is_refused(spark, landing, tmp_path):
    base = str(tmp_path / "lake")
    land(landing, 0, 1, 2)
    start(spark, landing, base)
    before = log_keys(spark, base)
    with pytest.raises(StreamingQueryException):
        start(spark, landing, base, checkpoint=str(tmp_path / "new-checkpoint"))
    assert log_keys(spark, base) == before


def test_a_lost_checkpoint_is_refused_after_one_commit(spark, landing, tmp_path):
    base = str(tmp_path / "lake")
    land(landing, 0)
    start(spark, landing, base)
    assert lake.read_commits(spark, base).first().writer
    with pytest.raises(StreamingQueryException):
        start(spark, landing, base, checkpoint=str(tmp_path / "new-checkpoint"))
    assert len(log_keys(spark, base)) == 2 and lake.read_log(spark, base, "warehouse").count() == 1


def test_a_replay_after_midnight_files_rows_once(spark, landing, tmp_path):
    base, filed = str(tmp_path / "lake"), str(tmp_path / "archive")
    (landing / "bare.txt").write_text(json.dumps({"expense_id": "a"}) + "\n" + json.dumps({"x": 1}) + "\n")
    os.utime(landing / "bare.txt", (86399, 86399))
    for _ in range(2):
        ingest.write_batch(events.read_events(spark, str(landing)), base, 1, None, filed)
    (row,) = lake.read_archive(spark, filed, log=base).collect()
    assert (row.expense_id, row.year, row.month, row.day) == ("a", "1970", "01", "01")
    (row,) = lake.read_archive(spark, filed, "_other", log=base).collect()
    assert (row.cdc_table, json.loads(row.body), row.day) == ("unknown", {"x": 1}, "01")


def test_a_job_and_a_stream_share_an_archive(spark, tmp_path):
    base, filed = str(tmp_path / "lake"), str(tmp_path / "archive")
    batch = spark.createDataFrame([(json.dumps(e),) for e in BATCHES[0]], "value string")
    ingest.write_batch(batch, base, 1, INGEST, filed)
    archive.write_archive(lake.read_log(spark, base), filed, "expenses", date=F.col("cdc_ts"))
    assert lake.read_archive(spark, filed).count() == 4
    later = lake.read_log(spark, base).withColumn("expense_id", F.lit("unlisted"))
    archive.write_archive(later, filed, "expenses", date=F.col("cdc_ts"), commit_id=2)
    assert lake.read_archive(spark, filed, log=base).count() == 4


def test_members_nobody_listed_and_empty_categories_survive(spark, tmp_path):
    base = str(tmp_path / "lake")
    rows = [{"w_id": 1, "w_name": "n", "w_manager": "kim", "w_note": None}, {"expense_id": "a"}, {"expense_id": "b", "shopping_type": None}, {"expense_id": "c", "shopping_type": "=x"}]
    ingest.write_batch(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"), base, 1, INGEST)
    assert lake.read_log(spark, base, "warehouse").first().rest == {"w_manager": "kim", "w_note": ""}
    log = lake.read_log(spark, base)
    assert {r.expense_id: r.shopping_type for r in log.collect()} == {"a": "", "b": None, "c": "=x"}
    assert log.filter("shopping_type = ''").count() == 1
    lake.register_log(spark, base, "landed_")
    assert spark.sql("SELECT COUNT(*) FROM landed_expenses WHERE commit_id <= (SELECT MAX(commit_id) FROM landed_commits)").first()[0] == 3


def test_counters_go_on_beyond_the_kept_progress_reports(spark, landing, tmp_path):
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        base = str(tmp_path / "lake")
        land(landing, 0, 1, 2, 3)
        start(spark, landing, base)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert stats.ingest_counts(lake.read_commits(spark, base)).first().batches == 4
