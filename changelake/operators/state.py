"""Current state: the newest image of every key.

``current_state`` keeps one image per key with ``max_by``.  Each task first
reduces its own rows to one image per key, so a key that owns a third of the
log costs one row per task in the shuffle and never meets in one place whole.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.sized import top_k
from changelake.operators.reports import amount, shown
from changelake.schemas import DELETE, INSERT, SNAPSHOT, UPDATE


def operation_rank(op: Column) -> Column:
    """Order of operations that carry the same change time."""
    return (
        F.when(op == SNAPSHOT, F.lit(0)).when(op == INSERT, F.lit(1)).when(op == UPDATE, F.lit(2)).otherwise(F.lit(3))
    )


def _newest(log: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Per key the greatest ``_newest``: order, operation, then the image's ``columns``."""
    ranked = [F.col(c) for c in order]
    if "cdc_operation" in log.columns:
        ranked.append(operation_rank(F.col("cdc_operation")).alias("_rank"))
    return log.groupBy(*keys).agg(F.max(F.struct(*ranked, *[c for c in columns if c not in keys and c not in order])).alias("_newest"))


def _opened(newest: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return newest.select(*[F.col(c) if c in keys else F.col(f"_newest.{c}") for c in columns])


def newest_images(log: DataFrame, keys: list[str], order: list[str], columns: list[str] | None = None) -> DataFrame:
    """One row per key: the image with the greatest order, deletes included.

    Equal orders are settled by the operation and then by the image itself, so
    the answer does not depend on how rows were distributed.  With ``columns``
    only these (and keys and operation) are read, and only they settle ties.
    """
    wanted = [c for c in log.columns if columns is None or c in {*keys, *columns, "cdc_operation"}]
    return _opened(_newest(log, keys, order, wanted), keys, wanted)


def current_state(log: DataFrame, keys: list[str], order: list[str], columns: list[str] | None = None) -> DataFrame:
    """Newest image per key without the keys whose newest change is a delete."""
    return newest_images(log, keys, order, columns).filter(F.col("cdc_operation") != DELETE)


def current_state_maxjoin(log: DataFrame, keys: list[str], ts: str = "cdc_ts") -> DataFrame:
    """All images whose change time is their key's greatest; ties all stay."""
    latest = log.groupBy(*keys).agg(F.max(ts).alias(ts))
    return log.join(latest, [*keys, ts], "inner").filter(F.col("cdc_operation") != DELETE).select(*log.columns)


def most_modified_audit(log: DataFrame, k: int = 5) -> DataFrame:
    """Every change of the ``k`` most often changed expenses."""
    changed = log.groupBy("expense_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    picked = top_k(changed, k, F.desc("n"), F.col("expense_id")).select("expense_id")
    return (
        log.join(picked, "expense_id", "left_semi")
        .select("expense_id", "cdc_operation", shown(amount()).alias("expense_amount"), "description", "cdc_ts")
        .orderBy("expense_id", "cdc_ts")
    )


def fold(base: DataFrame | None, log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Apply a change log to a table image: the table as the changes leave it.

    A base row stays unless the log names its key.  The log is reduced to one row
    per key once; that exchange serves both the keys that meet the base and the
    new images; rows without a key count as one key.  With few changed keys AQE broadcasts them and the base is never
    shuffled, and a hot key costs one row.
    """
    columns = [c for c in log.columns if c not in ("cdc_table", "cdc_operation", "cdc_timestamp", *order)]
    newest = _newest(log, keys, order, log.columns)
    changed = _opened(newest, keys, log.columns).filter(F.col("cdc_operation") != DELETE).select(*columns)
    if base is None:
        return changed
    # Null-safe, so that no filter on the keys makes this use of the exchange a different one.
    named = newest.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_newest")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    untouched = base.join(named, same, "left").filter(F.col("_newest").isNull())
    return untouched.select(*columns).unionByName(changed)
