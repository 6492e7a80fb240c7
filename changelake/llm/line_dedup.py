"""Line deduplication by overlapping windows of three lines, with DataFrame functions only.

Each window of three consecutive lines gets a 128-bit hash.  A window that occurs
more than once anywhere keeps its first occurrence (smallest id, then text hash, then
position); the lines under every later one go.  Windows overlap, so covered positions
are merged before lines are taken out.

Counting is a two-phase aggregate, so a window that is everywhere costs one partial
row per task; its occurrences meet that row through ``join_counted``.

Defined results: a null text has no lines and stays null; texts of fewer than three
lines stay as they are; windows without any word never count; rows equal in id and
text are one document and change alike; null ids come first; an empty table gives an
empty result; columns of ``df`` named like an added one are replaced.  Time grows with a
text's lines, in proportion.
"""

from __future__ import annotations

from changelake.llm.common import join_counted, stored
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def windows(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per window: ``__id, __text_hash, __at`` (from 0), ``__h1, __h2``."""
    lines = df.select(F.col(key).alias("__id"), F.xxhash64(text).alias("__text_hash"), F.split(F.col(text), "\n", -1).alias("__lines"))
    some = lines.filter(F.size("__lines") >= WINDOW)
    at = some.select("__id", "__text_hash", "__lines", F.explode(F.sequence(F.lit(0), F.size("__lines") - WINDOW)).alias("__at"))
    three = [F.get("__lines", F.col("__at") + i) for i in range(WINDOW)]
    worded = at.filter(F.concat(*three).rlike("[^ \\t\\n\\x0B\\f\\r]"))
    return worded.select("__id", "__text_hash", "__at", F.xxhash64(*three).alias("__h1"), F.xxhash64(F.lit(WINDOW), *three).alias("__h2"))


def covered(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per changed document ``__id, __text_hash`` and ``__gone``: covered line positions, ascending."""
    places = windows(df, key, text)
    first = (
        places.groupBy("__h1", "__h2")
        .agg(F.min(F.struct("__id", "__text_hash", "__at")).alias("__first"), F.count("*").alias("__times"))
        .filter("__times > 1")
    )
    again = join_counted(places, stored(first, "windows"), ["__h1", "__h2"], "__times", ["__id", "__text_hash", "__at"], "inner")
    later = again.filter(~F.struct("__id", "__text_hash", "__at").eqNullSafe(F.col("__first")))
    gone = later.select("__id", "__text_hash", F.explode(F.sequence(F.col("__at"), F.col("__at") + WINDOW - 1)).alias("__line"))
    return gone.groupBy("__id", "__text_hash").agg(F.sort_array(F.collect_set("__line")).alias("__gone"))


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the lines left in ``text``, and ``n_lines, n_removed, n_spans`` added."""
    gone = covered(df, key, text).withColumnsRenamed({"__id": "__gone_id", "__text_hash": "__gone_hash"})
    marked = df.withColumn("__text_hash", F.xxhash64(text))
    met = marked.join(gone, marked[key].eqNullSafe(gone["__gone_id"]) & (marked["__text_hash"] == gone["__gone_hash"]), "left")
    none = F.col("__gone").isNull()
    # A generator's result is not folded back: the lines are split once, not for every line kept.
    met = met.withColumn("__lines", F.explode(F.array(F.when(~none, F.split(F.col(text), "\n", -1)))))
    places = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    left = F.array_join(F.transform(places, lambda i: F.get("__lines", i)), "\n")
    starts = F.filter(F.col("__gone"), lambda p, i: (i == 0) | (F.get("__gone", i - 1) != p - 1))
    return met.select(
        *[c for c in df.columns if c not in (text, "n_lines", "n_removed", "n_spans")],
        F.when(none, F.col(text)).otherwise(left).alias(text),
        F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(F.col(text), "\n", -1))).cast("long").alias("n_lines"),
        F.when(none, 0).otherwise(F.size("__gone")).cast("long").alias("n_removed"),
        F.when(none, 0).otherwise(F.size(starts)).cast("long").alias("n_spans"),
    ).select(*df.columns, *[c for c in ("n_lines", "n_removed", "n_spans") if c not in df.columns])
