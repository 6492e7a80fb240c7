"""Quality rules as a short-circuit cascade, with DataFrame functions only.

Base figures of a text are columns.  Rules are conditions on them and on the text;
a text is rejected by the first that holds.  Before the run, every rule is tried on a
sample: its cost is the time of a job that evaluates it there over one that does not,
its selectivity the share it rejects.  Rules then stand in a CASE in order of
rejections per cost, which later rules of a rejected text never enter.  The order
changes the time, never the verdict.

Words are runs of anything but ASCII white space.  Repeated five-word windows are
found inside the row: word hashes make window hashes; only texts whose window hashes
are not distinct go on to sort (hash, position) and add up the covered words.

Defined results: a null text has no words; rows with null or repeated ids are rows
like any other; columns named like a figure or ``kept`` are replaced.
"""

from __future__ import annotations

import time

from changelake.llm.common import SPACE_RUN, SPACES, whole
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 400  # for the order of the rules only
WINDOW = 5
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_figures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the base figures and ``__words``, the text's words."""
    body = whole(text)
    trimmed = F.btrim(body, F.lit(SPACES))
    rows = df.drop(*FIGURES).withColumn("__words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN)))
    rows = rows.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    starts = F.sequence(F.lit(0), F.size("__hashes") - WINDOW)
    seen = F.transform(starts, lambda i: F.xxhash64(*[F.get("__hashes", i + j) for j in range(WINDOW)]))
    rows = rows.withColumn("__windows", F.when(F.size("__hashes") >= WINDOW, seen))
    # Pairs in hash order, for texts with a repeated window only.
    pairs = F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    rows = rows.withColumn("__pairs", F.when(repeats, pairs))
    beside = lambda p, k: (F.get("__pairs", k - 1)["h"] == p["h"]) | (F.get("__pairs", k + 1)["h"] == p["h"])
    marked = F.transform("__pairs", lambda p, k: F.when(F.coalesce(beside(p, k), F.lit(False)), p["i"]))
    places = F.array_sort(F.array_compact(marked))
    words_under = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = rows.withColumn("__lines", lines)
    return rows.select(
        *[c for c in rows.columns if c not in ("__hashes", "__windows", "__pairs", "__lines")],
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("__pairs").isNull(), 0).otherwise(words_under).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rules(text: str = "text") -> dict[str, Column]:
    """Rejecting conditions; the figures are at hand, the rest reads the text."""
    body = whole(text)
    n = F.col("n_words")
    letters = F.regexp_count(body, F.lit(r"\p{L}"))
    return {
        "base": base_failed(),
        "symbols": F.col("n_symbols") > 0.3 * n,
        "word_length": ~F.col("word_chars").between(2 * n, 20 * n),
        "repeated_lines": F.col("n_dup_lines") > 0.5 * F.size(F.split(body, "\n", -1)),
        "exclamations": F.regexp_count(body, F.lit(r"!(?=[ \t\n\x0B\f\r]|$)")) > 0.3 * n,
        "capitals": F.regexp_count(body, F.lit(r"\p{Lu}")) > 0.6 * letters,
        "letters": letters < 0.5 * F.col("word_chars"),
        "few_distinct_words": (n >= 50) & (F.size(F.array_distinct("__words")) < 0.1 * n),
    }


def cascade_order(df: DataFrame, text: str, conditions: dict[str, Column], rows: int = SAMPLE_ROWS) -> list[str]:
    """The rules by rejections per second on a sample of ``rows`` rows, best first."""
    texts = df.select(F.col(text).cast("string").alias(text))
    sample = with_figures(df.sparkSession.createDataFrame(texts.take(rows), texts.schema), text)

    def seconds(condition: Column) -> tuple[float, int]:
        begun = time.perf_counter()
        rejected = sample.agg(F.coalesce(F.sum(condition.cast("int")), F.lit(0))).first()[0]
        return time.perf_counter() - begun, rejected

    seconds(F.lit(False))  # starts the workers
    idle, _ = seconds(F.lit(False))
    found = {name: seconds(c) for name, c in conditions.items()}
    return sorted(found, key=lambda name: -found[name][1] / max(found[name][0] - idle, 1e-3))


def judge(df: DataFrame, text: str = "text", order: list[str] | None = None) -> DataFrame:
    """``df`` with the figures, ``base_failed`` and ``kept``; ``order`` saves the trial on a sample."""
    conditions = rules(text)
    order = order or cascade_order(df, text, conditions)
    kept = F.when(conditions[order[0]], False)
    for name in order[1:]:
        kept = kept.when(conditions[name], False)
    rows = with_figures(df.drop("base_failed", "kept"), text)
    rows = rows.withColumns({"base_failed": base_failed(), "__kept": kept.otherwise(True)})
    # A filter on the verdict stops at the generator; pushed on, it would repeat every figure's expression.
    return rows.withColumn("kept", F.explode(F.array("__kept"))).drop("__words", "__kept")
