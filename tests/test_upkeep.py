"""Compaction, images, partial figures, catalog tables, and attempts that were lost."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from changelake.operators import envelope, shaping
from changelake.operators import reports as R
from changelake.operators import state as S
from changelake.operators import versions as V
from changelake.plans.lake_queries import new_database, written_log
from changelake.plans.upkeep_queries import summed_log
from changelake.sinks import catalog_log, compaction, image, partials, snapshot
from changelake.sinks import log as log_sink
from changelake.sources import catalog, events, kafka, lake
from changelake.streaming import ingest, staging

SF = "/root/testdata/sf0.001"


def event(key, amount, at, removed=False, kind="Food"):
    row = {"expense_id": key, "merchant": "m", "expense_amount": amount, "shopping_type": kind}
    return {"before": row if removed else None, "after": None if removed else row, "updated": f"{at}000000000.0000000000"}


def land(spark, base, commit_id, *events, **more):
    ingest.write_batch(spark.createDataFrame([(json.dumps(e),) for e in events], "value string"), base, commit_id, "2024-06-01T00:00:00Z", **more)


def keys(df):
    return sorted((r.expense_id, str(r.expense_amount), r.cdc_operation, r.commit_id) for r in df.collect())


def test_segments_grow_by_tiers_and_readers_follow(spark, tmp_path):
    base = str(tmp_path / "lake")
    expected, made = [], []
    for n in range(1, 8):
        land(spark, base, n, event(f"k{n}", n, n, kind=["Food", "", "=x"][n % 3]), event("same", n, n))
        expected += [(f"k{n}", f"{n}.00", "insert", n), ("same", f"{n}.00", "insert", n)]
        assert keys(lake.read_log(spark, base)) == sorted(expected)
        if n % 2:
            made.append(compaction.compact(spark, base))
            assert keys(lake.read_log(spark, base)) == sorted(expected)
    assert compaction.compact(spark, base) is None
    active = lake.segments(spark, base, "expenses")
    assert [s.last for s in made] == [1, 3, 5, 7] and active[0].first == 1 and active[-1].last == 7
    assert all(a.last + 1 == b.first for a, b in zip(active, active[1:])) and len(active) < len(made)
    before = V.file_inventory(lake.read_log(spark, base, with_files=True)).collect()
    assert sum(r.record_count for r in before) == len(expected) and all("/segments/" in r.file_path for r in before)
    assert compaction.vacuum(spark, base) >= 7
    log = lake.read_log(spark, base)
    assert keys(log) == sorted(expected)
    assert keys(V.as_of(log, 3)) == sorted(e for e in expected if e[3] <= 3)
    assert {r.shopping_type for r in log.collect()} == {"Food", "", "=x"}
    land(spark, base, 8, event("k8", 8, 8))
    assert len(keys(lake.read_log(spark, base))) == len(expected) + 1
    assert compaction.compact(spark, base, "warehouse") is None and lake.read_log(spark, base, "warehouse").count() == 0


def test_a_compaction_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "lake")
    for n in (1, 2):
        land(spark, base, n, event("a", n, n))
    seen = keys(lake.read_log(spark, base))
    with monkeypatch.context() as m:
        m.setattr(compaction, "_bytes", lambda rows, calls=[]: calls.append(1) or (10 if len(calls) == 1 else 1 / 0))
        with pytest.raises(ZeroDivisionError):  # after the files were written, before they are listed
            compaction.compact(spark, base)
    assert lake.segments(spark, base, "expenses") == [] and keys(lake.read_log(spark, base)) == seen
    compaction.compact(spark, base)
    assert keys(lake.read_log(spark, base)) == seen


def test_a_reader_from_before_a_compaction_goes_on(spark, tmp_path):
    base = str(tmp_path / "lake")
    land(spark, base, 1, event("a", 1, 1))
    old = lake.read_log(spark, base)
    compaction.compact(spark, base)
    land(spark, base, 2, event("b", 2, 2))
    assert len(keys(old)) == 1


def test_a_lost_attempt_leaves_nothing(spark, tmp_path, monkeypatch):
    base, filed = str(tmp_path / "lake"), str(tmp_path / "archive")
    everything = [event("lost", 1, 1), {"w_id": 1, "w_name": "north"}, {"x": 1}, {"resolved": "2000000000.0000000000"}, "no event"]
    with monkeypatch.context() as m:
        m.setattr(ingest, "write_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            land(spark, base, 1, *everything, archive=filed)
    land(spark, base, 1, event("kept", 2, 100_000), archive=filed)
    assert [r.expense_id for r in lake.read_log(spark, base).collect()] == ["kept"]
    assert lake.read_log(spark, base, "warehouse").count() == 0
    for read in (lake.read_other_rows, lake.read_progress, lake.read_dead_letters):
        assert read(spark, base).count() == 0
    for table in ("expenses", "warehouse", lake.OTHER):
        assert lake.read_archive(spark, filed, table, log=base).count() == (table == "expenses")
    found = lake.read_partials(spark, base, partials.partials(lake.read_log(spark, base)).schema)
    assert partials.operation_totals(found).first().event_count == 1


def test_a_listed_commit_is_not_written_again(spark, tmp_path):
    base = str(tmp_path / "lake")
    batch = spark.createDataFrame([(json.dumps(event("a", 1, 1)),)], "value string")
    ingest.write_batch(batch, base, 1, "2024-06-01T00:00:00Z", None, "me")
    assert ingest.is_listed(batch, base, 1, "me") and not ingest.is_listed(batch, base, 2, "me")
    with pytest.raises(ValueError):
        ingest.is_listed(batch, base, 1, "another")


def test_image_takes_late_changes_and_deletes(spark, tmp_path):
    base, name = str(tmp_path / "lake"), f"`{new_database(spark)}`.`image`"
    image.create_image(spark, name, buckets=4)
    assert image.fold_commits(spark, base, name) == []
    batches = [
        [event("a", 1, 10), event("b", 1, 10), event("c", 1, 10)],
        [event("a", 2, 5), event("b", 2, 20, removed=True), event("d", 2, 1)],
        [event("b", 3, 15), event("c", 3, 30), event(None, 9, 30)],
    ]
    for n, events in enumerate(batches, 1):
        land(spark, base, n, *events)
        image.fold_commits(spark, base, name)
        log = lake.read_log(spark, base).dropna(subset=["expense_id"])
        whole = S.current_state(log, ["expense_id"], list(image.ORDER))
        assert keys(image.read_image(spark, name)) == keys(whole)
        assert image.stands_at(spark, name) == n
    # A fold that died before it was noted is done again, and changes nothing.
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{image.STANDS_AT}' = '1')")
    image.fold_commits(spark, base, name)
    assert keys(image.read_image(spark, name)) == keys(whole)


def test_image_is_not_exchanged_and_only_touched_slices_change(spark, tmp_path):
    base, name = written_log(spark, SF), f"`{new_database(spark)}`.`image`"
    image.create_image(spark, name)
    image.fold_commits(spark, base, name, to=4)
    slices = {r["slice"]: r["path"] for r in spark.table(name).groupBy("slice").agg(F.sort_array(F.collect_set("_metadata.file_path")).alias("path")).collect()}
    one = lake.read_log(spark, base).filter("expense_id = '56'").limit(1).withColumn("expense_amount", F.lit(1).cast("decimal(12,2)")).withColumn("cdc_ts", F.lit("2030-01-01").cast("timestamp"))
    log_sink.append_log(one, base, "expenses", 5)
    log_sink.write_commit(spark, base, 5, {})
    (touched,) = image.fold_commits(spark, base, name)
    after = {r["slice"]: r["path"] for r in spark.table(name).groupBy("slice").agg(F.sort_array(F.collect_set("_metadata.file_path")).alias("path")).collect()}
    assert {s for s in slices if slices[s] != after[s]} == {touched}
    changes = spark.table(name).limit(3)
    plan = image.merged(spark.table(name), changes.repartition(3), ("expense_id",))._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount" in plan and plan.count("Exchange hashpartitioning(new_expense_id") == 1 and "Exchange hashpartitioning(old_expense_id" not in plan


def test_partials_answer_without_the_log(spark):
    found = summed_log(spark, SF)
    for report in (partials.spending_by(found, "merchant", n=3), partials.operation_totals(found)):
        assert all("/partials/" in f or "/commits/" in f for f in report.inputFiles())
    with pytest.raises(ValueError):
        partials.spending_by(found, "description")
    again = partials.merged(found.withColumn("commit_id", F.lit(0)), "grain", "key", "cdc_operation")
    assert {tuple(r) for r in partials.spending_by(again, "recurring").collect()} == {tuple(r) for r in partials.spending_by(found, "recurring").collect()}


def test_catalog_follows_commits_and_segments(spark, tmp_path):
    base, database = str(tmp_path / "lake"), new_database(spark)
    other = spark.newSession()
    for n in range(1, 4):
        land(spark, base, n, event(f"k{n}'", n, n, kind=["a/b", "", "it's"][n % 3]), {"w_id": n, "w_name": "north", "more": 1})
        views = catalog_log.publish(spark, base, database, ["expenses", "warehouse"])
        assert keys(other.table(views[0])) == keys(lake.read_log(spark, base))
        assert other.table(views[1]).count() == n
    compaction.compact(spark, base, keep=1)
    assert keys(other.table(views[0])) == keys(lake.read_log(spark, base))  # still the commits
    catalog_log.publish(spark, base, database, ["expenses", "warehouse"])
    compaction.vacuum(spark, base)
    found = other.table(views[0])
    assert keys(found) == keys(lake.read_log(spark, base)) and "/segments/" in "".join(found.inputFiles())
    assert {r.shopping_type for r in found.collect()} == {"a/b", "", "it's"}
    assert found.columns == lake.log_fields("expenses").fieldNames()


def test_a_replayed_append_counts_once(spark, tmp_path):
    name = f"`{new_database(spark)}`.`expenses`"
    spark.sql(catalog_log.create_log_table_sql(name, "expenses"))
    rows = lake.read_log(spark, written_log(spark, SF)).filter("commit_id = 1").drop("commit_id").limit(5).cache()
    for commit_id in (1, 2, 2):
        catalog_log.append_commit(rows, name, commit_id)
    assert {(r.commit_id, r["count"]) for r in spark.table(name).groupBy("commit_id").count().collect()} == {(1, 5), (2, 5)}
    assert R.row_count(spark.table(name)).first()[0] == 10


def start(spark, landing, base, checkpoint, **more):
    stream = events.stream_events(spark, str(landing), max_files=2)
    return ingest.run_available(stream, str(base), str(checkpoint), "2024-06-01T00:00:00Z", timeout=120, **more)


def test_a_query_without_its_checkpoint_goes_on(spark, tmp_path, monkeypatch):
    landing, base = tmp_path / "landing", tmp_path / "lake"
    landing.mkdir()

    def add(*numbers):
        for n in numbers:
            (landing / f"{n}.txt").write_text("\n".join(json.dumps(e) for e in (event(f"k{n}", n, n), {"w_id": n, "w_name": "x"})) + "\n")

    def seen():
        found = [r.expense_id for r in lake.read_log(spark, str(base)).collect()]
        assert lake.read_log(spark, str(base), "warehouse").count() == len(found)
        return sorted(found)

    add(1, 2, 3)
    start(spark, landing, base, tmp_path / "first")
    add(4)
    start(spark, landing, base, tmp_path / "second", resume=True)  # the first checkpoint is lost
    assert seen() == ["k1", "k2", "k3", "k4"]
    start(spark, landing, base, tmp_path / "second", resume=True)  # nothing new
    add(5, 6, 7)
    with monkeypatch.context() as m:
        m.setattr(ingest, "write_commit", lambda *a: 1 / 0)
        with pytest.raises(Exception):
            start(spark, landing, base, tmp_path / "second", resume=True)
    start(spark, landing, base, tmp_path / "second", resume=True)
    assert seen() == [f"k{n}" for n in range(1, 8)]
    commits = lake.read_commits(spark, str(base))
    ids = sorted(r.commit_id for r in commits.collect())
    assert ids == list(range(1, len(ids) + 1)) and commits.select("writer").distinct().count() == 2
    add(8)
    with pytest.raises(Exception, match="the log already has"):  # the first checkpoint turns up again
        start(spark, landing, base, tmp_path / "first", resume=True)
    assert seen() == [f"k{n}" for n in range(1, 8)]


def test_a_replay_of_a_resumed_commit_writes_nothing(spark, tmp_path):
    base = str(tmp_path / "lake")
    batch = spark.createDataFrame([(json.dumps(event("a", 1, 1)), "f")], "value string, source string")
    ingest.write_batch(batch, base, 1, "2024-06-01T00:00:00Z", None, "old")
    assert ingest.first_commit(batch, base, 0, "new") == 2
    with pytest.raises(ValueError, match="no commit of this query"):
        ingest.first_commit(batch, base, 3, "new")
    assert sum(ingest.write_batch(batch, base, 2, "2024-06-01T00:00:00Z", None, "new", True).values()) == 0
    assert ingest.first_commit(batch, base, 5, "new") == 2 and ingest.is_listed(batch, base, 2, "new")
    assert len(keys(lake.read_log(spark, base))) == 1


def test_offsets_and_unknown_sources(spark, tmp_path):
    base, schema = str(tmp_path / "lake"), "topic string, partition int, offset bigint, value binary"

    def messages(*where):
        return kafka.decode(spark.createDataFrame([("t", p, o, json.dumps(event(f"{p}-{o}", 1, 1)).encode()) for p, o in where], schema))

    ingest.write_batch(messages((0, 1), (0, 2), (1, 7)), base, 1)
    ingest.write_batch(messages((0, 1), (0, 2), (0, 3), (1, 7), (1, 8), (2, 1)), base, 2, resume=True)
    assert sorted(r.expense_id for r in lake.read_log(spark, base).collect()) == ["0-1", "0-2", "0-3", "1-7", "1-8", "2-1"]
    with pytest.raises(ValueError, match="does not say"):
        ingest.write_batch(spark.createDataFrame([("{}",)], "value string"), base, 3, resume=True)
    land(spark, base, 3, event("untold", 1, 1))
    with pytest.raises(ValueError, match="would be doubled"):
        ingest.first_commit(messages((0, 1)), base, 0, "new")
    nowhere = spark.createDataFrame([(json.dumps(event("n", 1, 1)), None)], "value string, source string")
    assert ingest.write_batch(nowhere, base, 4, resume=True)["expenses"] == 1


def scanned_rows(spark, df):
    """Rows that file scans handed on: those of pages and row groups that were not skipped."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        rows = [r.expense_id for r in df.collect()]
        found, todo = 0, [plan]
        while todo:
            node = todo.pop()
            if "FileSourceScan" in node.getClass().getSimpleName():
                found += node.metrics().apply("numOutputRows").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    return found, rows


@pytest.mark.parametrize("compacted", [False, True])
def test_a_key_lookup_skips_row_groups_and_pages(spark, tmp_path, compacted):
    base, n = str(tmp_path / "lake"), 200_000
    rows = spark.range(n).select(F.format_string("k%07d", F.col("id") * 2).alias("expense_id"), F.lit("Food").alias("shopping_type"), F.lit("insert").alias("cdc_operation"))
    schema = lake.log_fields("expenses")
    whole = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    for commit_id in (1, 2):
        log_sink.append_log(whole.repartition(4), base, "expenses", commit_id)
        log_sink.write_commit(spark, base, commit_id, {"expenses": n})
    if compacted:
        compaction.compact(spark, base)
    log = lake.read_log(spark, base).select("expense_id")
    found, rows = scanned_rows(spark, log.filter(F.col("expense_id") == "k0100000"))
    assert rows == ["k0100000"] * 2 and 0 < found <= 2 * n // 4
    absent, rows = scanned_rows(spark, log.filter(F.col("expense_id") == "k0100001"))
    assert rows == [] and absent == 0  # within every file's range: only the Bloom filter knows


def test_counts_come_from_the_catalog(spark):
    name, never = (f"`{new_database(spark)}`.`t`" for _ in range(2))
    for table in (name, never):
        spark.range(7).write.saveAsTable(table)
    catalog.analyze(spark, [name])
    counts = catalog.estimated_row_counts(spark, [name, never])
    assert [r.row_count for r in counts.collect()] == [7, None]
    assert "Scan parquet" not in counts._jdf.queryExecution().executedPlan().toString()


def test_a_snapshot_rewrites_only_what_the_log_touched(spark, tmp_path):
    base, table = str(tmp_path / "lake"), f"`{new_database(spark)}`.`s`"

    def live(*rows):
        made = spark.createDataFrame(list(rows), "expense_id string, shopping_type string, expense_amount int")
        return made.select("*", *[F.lit(None).cast("string").alias(c) for c in ("user_id", "description", "merchant", "expense_date", "payment_method")], F.lit(None).cast("boolean").alias("recurring"))

    def shown():
        return sorted((r.expense_id, r.shopping_type or "", int(r.expense_amount), r.snapshot_timestamp) for r in spark.table(table).collect())

    land(spark, base, 1, event("a", 1, 1, kind="Food"), event("b", 1, 1, kind="Rent"), event("c", 1, 1, kind="it's"), event("d", 1, 1, kind=""))
    snapshot.materialize_snapshot(live(("a", "Food", 1), ("b", "Rent", 1), ("c", "it's", 1), ("d", "", 1)), table, "t1")
    log = lake.read_log(spark, base)
    with pytest.raises(ValueError):
        snapshot.refresh_by_log(live(), log, table, 1)
    snapshot.mark_version(spark, table, 1)
    assert snapshot.refresh_by_log(live(), log, table, 1) == []
    files = {r.path for r in spark.table(table).select("shopping_type", F.col("_metadata.file_path").alias("path")).filter("shopping_type = 'Food'").collect()}
    # c moves to Rent, which empties its old category; d goes
    land(spark, base, 2, event("c", 2, 2, kind="Rent"), event("d", 1, 2, removed=True, kind=""))
    log = lake.read_log(spark, base)
    now = live(("a", "Food", 1), ("b", "Rent", 1), ("c", "Rent", 2))
    assert sorted(snapshot.refresh_by_log(now, log, table, 2, "t2"), key=str) == [None, "Rent", "it's"]
    assert shown() == [("a", "Food", 1, "t1"), ("b", "Rent", 1, "t2"), ("c", "Rent", 2, "t2")]
    assert {r.path for r in spark.table(table).select("shopping_type", F.col("_metadata.file_path").alias("path")).filter("shopping_type = 'Food'").collect()} == files
    assert snapshot.marked_version(spark, table) == 2


def misc(**members):
    return {"__table__": "misc", **members}


def test_types_of_commits_merge_as_if_read_at_once(spark, tmp_path):
    base = str(tmp_path / "lake")
    one = [misc(id=1, n=1, f=True, z=None, cdc_table="x", A=1), misc(id=2, n=2, f=None, z=None, A=2)]
    two = [misc(id=3, n=2.5, f="text", z=None, a="low"), misc(id=4, n=None, o={"deep": [1]}), {"__table__": "else", "id": "text"}]
    land(spark, base, 1, *one)
    before = lake.read_typed_rows(spark, base, "misc")
    assert dict(before.dtypes)["n"] == "bigint" and dict(before.dtypes)["f"] == "boolean"
    land(spark, base, 2, *two)
    now = lake.read_typed_rows(spark, base, "misc")
    # The same members and types as one batch of all rows.
    whole = spark.createDataFrame([(json.dumps(e),) for e in one + two], "value string")
    at_once = shaping.inferred_rows(envelope.normalize(whole, "2024-06-01T00:00:00Z").rows, "misc")
    assert now.drop("commit_id").dtypes == at_once.dtypes
    assert sorted(map(repr, now.drop("commit_id").collect())) == sorted(map(repr, at_once.collect()))
    assert {(r.id, r.commit_id) for r in now.collect()} == {(1, 1), (2, 1), (3, 2), (4, 2)}
    assert dict(now.dtypes) | {"n": "double", "f": "string", "z": "string", "A": "bigint", "a_2": "string"} == dict(now.dtypes)
    assert lake.read_typed_rows(spark, base, "misc", as_of=1).dtypes == before.dtypes
    assert {json.loads(b)["id"] for (b,) in lake.read_other_rows(spark, base).select("body").collect()} == {1, 2, 3, 4, "text"}
    assert lake.read_typed_rows(spark, base, "nobody").count() == 0


def staged_events(spark, *events):
    return spark.createDataFrame([(json.dumps(e),) for e in events], "value string")


def test_tables_wait_for_rows_or_age_and_survive_lost_attempts(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "lake")
    began = datetime(2024, 6, 1, tzinfo=timezone.utc)
    stamp = "2024-06-01T00:00:00Z"

    def step(k, *events):
        now = began + timedelta(seconds=10 * k)
        staging.stage_batch(staged_events(spark, *events), base, k, stamp, now)
        return staging.release(spark, base, 3, 25, now)

    quiet = {"w_id": 1, "w_name": "a", "w_street_1": "b"}
    assert step(0, *[event(f"a{i}", i, i) for i in range(3)], quiet, {"resolved": "1"}, misc(k=1)) == 1
    assert keys(lake.read_log(spark, base)) == [(f"a{i}", f"{i}.00", "insert", 1) for i in range(3)]
    assert lake.read_log(spark, base, "warehouse").count() == 0 and lake.read_progress(spark, base).count() == 0
    assert step(1, event("b", 1, 9)) is None and step(1, event("b", 1, 9)) is None  # delivered twice
    assert {r.target: r.rows for r in staging.waiting(spark, base).collect()} == {"warehouse": 1, "progress": 1, "_other": 1, "expenses": 1}
    # A release that dies before it is listed shows nothing and is made again.
    with monkeypatch.context() as m:
        m.setattr(staging, "write_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            step(3, event("c", 2, 10))
    assert lake.read_log(spark, base, "warehouse").count() == 0
    assert step(3, event("c", 2, 10)) == 2  # the quiet ones have waited long enough, b not yet
    assert lake.read_log(spark, base, "warehouse").count() == 1 and lake.read_progress(spark, base).count() == 1
    assert lake.read_typed_rows(spark, base, "misc").select("k", "commit_id").collect() == [(1, 2)]
    assert [k[0] for k in keys(lake.read_log(spark, base))] == ["a0", "a1", "a2"]
    assert staging.release(spark, base, 0, 25, began) == 3 and staging.release(spark, base, 0, 25, began) is None
    assert [(k[0], k[3]) for k in keys(lake.read_log(spark, base))] == [("a0", 1), ("a1", 1), ("a2", 1), ("b", 3), ("c", 3)]
    assert staging.vacuum_stages(spark, base) == 2 and step(0, event("a0", 0, 0)) is None
    assert sum(int(n) for r in lake.read_commits(spark, base).collect() for n in r.summary.values()) == 8


def test_a_staged_stream_restarts_and_refuses_another_checkpoint(spark, tmp_path):
    landing, base = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()

    def run(checkpoint, most_rows):
        stream = events.stream_events(spark, str(landing))
        query = staging.run_staged(stream, base, str(tmp_path / checkpoint), {"availableNow": True}, "2024-06-01T00:00:00Z", most_rows, 3600)
        query.awaitTermination()

    (landing / "1.json").write_text(json.dumps(event("a", 1, 1)))
    run("one", 2)
    assert lake.read_log(spark, base).count() == 0
    with pytest.raises(Exception, match="written by another query"):
        run("three", 2)
    (landing / "2.json").write_text(json.dumps(event("b", 1, 2)))
    run("one", 2)
    assert sorted(k[0] for k in keys(lake.read_log(spark, base))) == ["a", "b"]
    with pytest.raises(Exception, match="the log already has 1"):
        run("two", 2)
