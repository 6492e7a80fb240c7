"""Event feeds in every envelope, written from the given tables as JSON text.

All changes of one expense sit in one row before they are spread out, so the
images before and after a change need no window and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.plans import fixtures as X
from changelake.schemas import OPERATION_CODES, RAW_BEFORE, RAW_EVENT_TYPE, RAW_UPDATED

KEEP_NULLS = {"ignoreNullFields": "false"}


def to_json(*members: Column) -> Column:
    """An object with its null members kept, as change feeds send them."""
    return F.to_json(F.struct(*members), KEEP_NULLS)


def image(step: Column) -> Column:
    return F.struct(*X.image_at(step))


def after_image(step: Column) -> Column:
    return F.when(step != 3, image(step)).alias("after")


def before_image(step: Column) -> Column:
    return F.when(step > 0, image(step - 1)).alias("before")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def clock_text(ts: Column) -> Column:
    """Nanoseconds with a logical counter, the changefeed's own clock."""
    return F.concat((micros(ts) * 1000).cast("string"), F.lit(".0000000000"))


def pair_event(step: Column, ts: Column) -> Column:
    return to_json(before_image(step), after_image(step), clock_text(ts).alias("updated"))


def code_of(op: Column) -> Column:
    out = F.lit(None).cast("string")
    for code, name in OPERATION_CODES.items():
        out = F.when(op == name, F.lit(code)).otherwise(out)
    return out


def coded_members(step: Column, op: Column, ts: Column) -> list[Column]:
    return [
        code_of(op).alias("op"),
        before_image(step),
        after_image(step),
        F.floor(micros(ts) / 1000).cast("bigint").alias("ts_ms"),
        F.struct(F.lit("expenses").alias("table")).alias("source"),
    ]


def _feed(df: DataFrame, value: Column, feed: Column | None = None) -> DataFrame:
    return X.spread(df).select((feed if feed is not None else F.lit("fixture")).alias("feed"), value.alias("value"))


def pair_feed(spark: SparkSession, sf_dir: str, feed: Column | None = None) -> DataFrame:
    """One before/after event per body."""
    return _feed(X.changes(spark, sf_dir), pair_event(F.col("seq"), X.change_time()), feed)


def coded_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One operation-coded event per body, nested under ``payload``."""
    members = coded_members(F.col("seq"), X.operation(), X.change_time())
    return _feed(X.changes(spark, sf_dir), to_json(F.struct(*members).alias("payload")))


def coded_flat_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One operation-coded event per body, already unwrapped."""
    return _feed(X.changes(spark, sf_dir), to_json(*coded_members(F.col("seq"), X.operation(), X.change_time())))


def _bodies(spark: SparkSession, sf_dir: str, opening: str, closing: str) -> DataFrame:
    key = F.col("k")
    present = {0: F.lit(True), 1: key % 4 == 0, 2: key % 8 == 0, 3: key % 7 == 0}
    events = [
        F.when(cond, pair_event(F.lit(step), X.plus_days(F.col("d0"), F.lit(step)))) for step, cond in present.items()
    ]
    body = F.concat(F.lit(opening), F.concat_ws(",", *events), F.lit(closing))
    return _feed(X.expense_base(spark, sf_dir), body)


def batch_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One body per expense holding all its changes: ``{"payload": [...]}``."""
    return _bodies(spark, sf_dir, '{"payload":[', "]}")


def list_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One body per expense holding all its changes: ``[...]``."""
    return _bodies(spark, sf_dir, "[", "]")


def bare_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live table as bare rows."""
    live = X.live(spark, sf_dir)
    return _feed(live, to_json(*[F.col(c) for c in live.columns]))


def order_entry_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bare rows of every table, and JSON objects that belong to none."""
    feeds = [bare_feed(spark, sf_dir), _feed(X.table(spark, sf_dir, "events"), F.col("props"))]
    for df in X.order_entry(spark, sf_dir).values():
        columns = [c for c in df.columns if not c.startswith("cdc_")]
        feeds.append(_feed(df, to_json(*[F.col(c) for c in columns])))
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f)
    return out


def marked_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed per category: its changes and, per expense, a resolved marker."""
    category = F.col("shopping_type")
    markers = _feed(X.expense_base(spark, sf_dir), to_json(clock_text(F.col("d0")).alias("resolved")), category)
    return pair_feed(spark, sf_dir, category).unionByName(markers)


def broken_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that are mostly not changes, one kind per last digit of the key."""
    good = pair_event(F.lit(0), F.col("d0"))
    key = F.col("k")
    kinds = {
        0: F.substring(good, 1, 40),
        1: F.lit('{"after": null}'),
        2: F.lit('{"after": {}}'),
        3: F.concat(F.lit('"'), F.col("merchant"), F.lit('"')),
        4: F.lit("null"),
        5: F.lit('{"payload": {"op": "u", "before": null, "after": null}}'),
        6: F.lit("{}"),
        7: F.concat(F.lit('{"after": '), F.col("expense_id"), F.lit("}")),
        8: to_json(F.struct(F.col("expense_id"), F.lit("n/a").alias("expense_amount")).alias("after")),
    }
    value = good
    for digit, body in kinds.items():
        value = F.when(key % 10 == digit, body).otherwise(value)
    return _feed(X.expense_base(spark, sf_dir), value)


def sparse_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that leave out or null some members, by key."""
    key = F.col("k")
    null = F.lit(None).cast("string")
    absent = F.to_json(F.struct("expense_id", F.when(key % 2 == 0, F.col("merchant")).alias("merchant")))
    nulled = to_json(F.col("expense_id"), F.when(key % 2 == 0, F.col("merchant")).alias("merchant"), null.alias("expense_amount"))
    return _feed(X.expense_base(spark, sf_dir), F.when(key % 3 == 0, nulled).otherwise(absent))


def typed_order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows with JSON numbers, flags and a nested member."""
    o = X.table(spark, sf_dir, "orders")
    body = to_json(
        F.col("o_orderkey").alias("o_id"),
        F.col("o_custkey").alias("o_c_id"),
        (F.col("o_orderkey") % 2 == 0).alias("o_all_local"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("o_ol_cnt"),
        F.struct(F.col("o_orderstatus").alias("code")).alias("o_entry_d"),
        F.lit(None).cast("string").alias("o_carrier_id"),
    )
    return _feed(o, body)


def part_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table nobody registered, named by the event itself.

    ``p_brand`` appears only in some rows and prices mix whole and broken numbers.
    """
    p = X.table(spark, sf_dir, "part")
    price = F.when(F.col("p_partkey") % 2 == 0, F.floor("p_retailprice").cast("string")).otherwise(
        F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    )
    head = F.to_json(
        F.struct(
            F.lit("part").alias("__table__"),
            "p_partkey",
            "p_name",
            "p_size",
            F.when(F.col("p_partkey") % 5 > 0, F.col("p_brand")).alias("p_brand"),
        )
    )
    body = F.concat(F.expr("substr(_head, 1, length(_head) - 1)"), F.lit(',"p_retailprice":'), price, F.lit("}"))
    return _feed(p.withColumn("_head", head), body)


def raw_changefeed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as a Parquet changefeed writes them; deletes carry only the key."""
    seq = F.col("seq")
    deleted = seq == 3
    code = F.when(seq == 0, F.lit("c")).when(deleted, F.lit("d")).otherwise(F.lit("u"))
    images = {c: F.when(~deleted, v) for c, v in zip(IMAGE_COLUMNS, X.image_at(seq)) if c != "expense_id"}
    return X.changes(spark, sf_dir).select(
        "expense_id",
        *[v.alias(c) for c, v in images.items()],
        F.array("merchant", "shopping_type").alias("tags"),
        F.col("d0").cast("timestamp").alias("created_at"),
        code.alias(RAW_EVENT_TYPE),
        clock_text(X.change_time()).alias(RAW_UPDATED),
        F.when(seq > 0, to_json(*X.image_at(seq - 1))).alias(RAW_BEFORE),
    )


IMAGE_COLUMNS = (
    "expense_id",
    "user_id",
    "description",
    "merchant",
    "expense_amount",
    "expense_date",
    "shopping_type",
    "payment_method",
    "recurring",
)
