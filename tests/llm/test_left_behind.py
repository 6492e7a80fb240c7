"""What the corpus operators leave on disk, and how anchors travel."""

import os
import time

import numpy as np
import pyarrow as pa

import corpus_pipeline
from changelake.llm import common, near_dedup, suffix_dedup
from changelake.workdir import shared_root
from pyspark.sql import functions as F

WORDS = [f"word{i * 7919 % 1000}" for i in range(400)]


def docs_of(spark):
    rows = [(i, " ".join(WORDS[i * 3 : i * 3 + 60])) for i in range(40)] + [(50, " ".join(WORDS[:60])), (None, " ".join(WORDS[5:90]))]
    return spark.createDataFrame(rows, "doc_id long, text string")


def tables(spark):
    folder = f"{shared_root(spark).removeprefix('file:')}/changelake"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def names_of(made):
    return sorted(name.rpartition("-")[0] for name in made)


def test_suffix_dedup_and_near_dedup_leave_only_what_their_results_read(spark):
    docs = docs_of(spark)
    before = tables(spark)
    changed = suffix_dedup.dedup(docs)
    assert names_of(tables(spark) - before) == ["llm-spans"]
    assert changed.filter("n_removed > 0").count() > 0
    before = tables(spark)
    kept = near_dedup.representatives(docs)
    assert names_of(tables(spark) - before) == ["llm-kept"]
    assert kept.count() < docs.count()


def test_texts_of_one_id_keep_their_numbers(spark):
    docs = spark.createDataFrame([(1, "a" * 30 + " ".join(WORDS[:30])), (1, "b" * 30 + " ".join(WORDS[:30])), (0, " ".join(WORDS[:30]))], "doc_id long, text string")
    found = {r.text: r.n_removed for r in suffix_dedup.dedup(docs).collect()}
    assert len(found) == 3 and sorted(n > 0 for n in found.values()) == [False, True, True]


def test_pipeline_drops_a_stage_that_the_next_has_taken_in(spark, tmp_path, monkeypatch):
    docs_of(spark).write.parquet(f"{tmp_path}/documents.parquet")
    stages = [(name, lambda spark, docs, sf_dir, at=at: docs.filter(F.col("doc_id") != at)) for at, name in enumerate("abcd")]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    before = tables(spark)
    left = corpus_pipeline.run(spark, str(tmp_path))
    assert names_of(tables(spark) - before) == ["llm-stage-c"]
    assert left.count() == 37 and spark.read.parquet(f"{tmp_path}/documents.parquet").count() == 42


def test_a_stored_table_leaves_no_shuffle_files(spark):
    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(common._CLEANUP, None)
    grouped = spark.range(1000).groupBy("id").count()
    made = common.stored(grouped, "test")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(common._CLEANUP, None) == setting and made.count() == 1000


def test_scratch_is_cleared_when_a_step_fails(spark):
    before = tables(spark)
    try:
        with common.scratch(spark):
            common.stored(spark.range(3), "test-gone")
            kept = common.stored(spark.range(3), "test-kept", keep=True)
            raise ValueError
    except ValueError:
        pass
    assert names_of(tables(spark) - before) == ["llm-test-kept"] and kept.count() == 3


def test_anchors_of_two_ids_meet_side_by_side():
    rng = np.random.default_rng(7)
    sent, owners, parts = [], {}, 5
    for _ in range(6):  # blocks of several documents; anchor 0 is everywhere, some ids are null
        found = np.concatenate([rng.integers(-400, 400, 300), np.zeros(20, np.int64)])
        owner = rng.choice([*range(60), suffix_dedup.LAST], len(found))
        variant = np.where(owner == suffix_dedup.LAST, rng.integers(0, 3, len(found)), 0).astype(np.int32)
        for row in zip(found.tolist(), owner.tolist(), variant.tolist()):
            owners.setdefault(row[0], set()).add(row[1:])
        columns = suffix_dedup._meeting(found, owner, variant)
        sent.append(suffix_dedup._packed(suffix_dedup._part_of(columns[0], parts), columns, ["r", "h", "d", "v", "f"]))
    assert all(b.num_rows <= parts for b in sent)  # not a row for each anchor
    kinds = [np.int64, np.int64, np.int64, np.int32, np.int64]
    got = []
    for columns in suffix_dedup._unpacked(iter(sent), kinds).values():
        got += zip(*(x.tolist() for x in suffix_dedup._met(*columns)))
    want = {(h, *o) for h, who in owners.items() if len({d for d, _ in who}) > 1 for o in who}
    assert set(got) == want and any(len(who) == 1 for who in owners.values())
    empty = suffix_dedup._packed(np.empty(0, np.int32), [np.empty(0, np.int64)], ["h"])
    assert empty.num_rows == 0 and suffix_dedup._unpacked(iter([empty]), [np.int64]) == {} and isinstance(empty, pa.RecordBatch)
