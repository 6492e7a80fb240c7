"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept; all
but the last return the columns of ``documents``, with ``n_chars`` brought up to date.
Stages are stored between each other, so that a lost executor repeats one stage's
share at most.
"""

from __future__ import annotations

from changelake.llm import line_dedup, near_dedup, packing, quality_rules, suffix_dedup
from changelake.llm.common import dropped, read, stored
from changelake.llm.queries import CAPACITY, PACK_TOKENIZER, tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``changed``, ``n_chars`` counted again."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return changed.select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    kept = [c for c in docs.columns if c not in (*quality_rules.FIGURES, "base_failed", "kept")]
    return quality_rules.judge(docs).filter("kept").select(*kept)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of three-line windows; emptied ones go."""
    changed = line_dedup.dedup(docs)
    return _with_text(docs, changed.filter((F.col("n_removed") == 0) | (F.col("text") != "")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return near_dedup.representatives(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of earlier ones; emptied ones go."""
    changed = suffix_dedup.dedup(docs)
    return _with_text(docs, changed.filter((F.col("n_removed") == 0) | (F.col("text") != "")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences."""
    made = packing.pieces(docs.select("doc_id", "text"), tokenizer_path(PACK_TOKENIZER), CAPACITY)
    return packing.pack(made.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), CAPACITY)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near_copies), ("suffix_dedup", passages), ("packing", packed)]

#: Near copies, suffix order and packing are not for SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if i:  # the first one reads the given table
            dropped(before)
    return STAGES[-1][1](spark, docs, sf_dir)
