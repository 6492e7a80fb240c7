"""Row changes on a live table, as DataFrames: the new table and its events.

The picked keys are usually a top-k, whose size Catalyst knows: the live table is
then marked by a broadcast join; other keys meet it in a shuffled one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.sized import top_k
from changelake.schemas import DELETE, INSERT, UPDATE

KEY = "expense_id"


def pick_top(live: DataFrame, k: int, *order: Column, where: Column | None = None) -> DataFrame:
    """Keys of the first ``k`` rows of an order."""
    rows = live if where is None else live.filter(where)
    return top_k(rows, k, *order).select(KEY)


def _marked(live: DataFrame, pick: DataFrame) -> DataFrame:
    hits = pick.select(KEY).withColumn("_hit", F.lit(True))
    return live.join(hits, KEY, "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))


def _event(op: str, before: Column | None, after: Column | None, schema) -> list[Column]:
    nothing = F.lit(None).cast(schema)
    return [
        F.lit(op).alias("cdc_operation"),
        (nothing if before is None else before).alias("before"),
        (nothing if after is None else after).alias("after"),
    ]


def _image(columns: list[str]) -> Column:
    return F.struct(*columns)


def apply_update(live: DataFrame, pick: DataFrame, assignments: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Assign columns of the picked rows; values are cast back to the column types."""
    columns, schema = live.columns, live.schema
    marked = _marked(live, pick)
    changed = {c: v.cast(schema[c].dataType) for c, v in assignments.items()}
    new = marked.select(
        *[F.when(F.col("_hit"), changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in columns]
    )
    after = F.struct(*[changed[c].alias(c) if c in changed else F.col(c) for c in columns])
    events = marked.filter("_hit").select(*_event(UPDATE, _image(columns), after, schema))
    return new, events


def apply_delete(live: DataFrame, pick: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove the picked rows."""
    keys = pick.select(KEY)
    new = live.join(keys, KEY, "left_anti").select(*live.columns)
    gone = live.join(keys, KEY, "left_semi").select(*live.columns)
    return new, gone.select(*_event(DELETE, _image(live.columns), None, live.schema))


def apply_insert(live: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add rows."""
    added = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in live.schema.fields])
    return live.unionByName(added), added.select(*_event(INSERT, None, _image(live.columns), live.schema))


def log_rows(events: DataFrame, ts: Column) -> DataFrame:
    """Change-log rows of before/after events: the new image, or the old one of a delete."""
    image = F.coalesce("after", "before").alias("_image")
    return events.select("cdc_operation", image).select(
        "_image.*", F.lit("expenses").alias("cdc_table"), "cdc_operation", ts.alias("cdc_ts")
    )
