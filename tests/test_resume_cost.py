"""A query that goes on without its checkpoint parses only what no commit has."""

from changelake.sources import lake
from changelake.streaming import ingest


def test_resume_parses_only_what_is_new(spark, tmp_path, monkeypatch):
    def feed(keys):
        rows = [(f'{{"__table__": "expenses", "after": {{"expense_id": "{k}"}}}}', f"file-{k // 10}" if k is not None and k < 90 else None) for k in keys]
        return spark.createDataFrame(rows, "value string, source string")

    base, parsed, unpack = str(tmp_path / "log"), [], ingest.unpack

    def counted(raw):
        parsed.append(raw.count())
        return unpack(raw)

    monkeypatch.setattr(ingest, "unpack", counted)
    ingest.write_batch(feed(range(30)), base, 1, "2024-06-01T00:00:00Z")
    counts = ingest.write_batch(feed([*range(35), 90, 91]), base, 2, "2024-06-01T00:00:00Z", resume=True)
    assert parsed == [30, 7] and counts == {"expenses": 7}
    log = lake.read_log(spark, base)
    assert sorted(int(r.expense_id) for r in log.collect()) == [*range(35), 90, 91]
    intake = {(r.commit_id, r.source) for r in lake.read_intake(spark, base).collect()}
    assert intake == {(1, f"file-{i}") for i in range(3)} | {(2, f"file-{i}") for i in range(4)} | {(2, None)}


def test_resume_leaves_out_offsets_that_a_commit_has(spark, tmp_path):
    def feed(places):
        rows = [(f'{{"__table__": "expenses", "after": {{"expense_id": "{s}{p}"}}}}', s, p) for s, p in places]
        return spark.createDataFrame(rows, "value string, source string, position long")

    base = str(tmp_path / "log")
    ingest.write_batch(feed([("a", 1), ("a", 2), ("b", 7)]), base, 1, "2024-06-01T00:00:00Z")
    ingest.write_batch(feed([("a", 1), ("a", 2), ("a", 3), ("b", 7), ("b", None), ("c", 0)]), base, 2, "2024-06-01T00:00:00Z", resume=True)
    assert sorted(r.expense_id for r in lake.read_log(spark, base).collect()) == ["a1", "a2", "a3", "b7", "c0"]
    assert {(r.source, r.position) for r in lake.read_intake(spark, base).filter("commit_id = 2").collect()} == {("a", 3), ("b", 7), ("c", 0)}
