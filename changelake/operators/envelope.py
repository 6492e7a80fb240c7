"""Change events in any envelope -> one change log.

A feed is a DataFrame with a text column ``value`` (one JSON body per row) and,
optionally, a text column ``feed`` naming where it came from and a timestamp
``received_at`` of its arrival, which stands in for change times that are missing.  Everything here
is a narrow projection: bodies are parsed once into VARIANT, unpacked with
``explode`` and classified; nothing is shuffled.

Envelopes understood:

* a list of events, ``{"payload": [events]}``, or one event;
* before/after pairs, where the two images decide the operation;
* operation-coded envelopes, nested under ``payload`` or flat;
* bare rows of an initial scan;
* ``{"resolved": time}`` progress markers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.event_time import event_seq, event_time
from changelake.functions.rows import (
    IDENTIFYING,
    field,
    is_json_null,
    is_object,
    is_truthy,
    members,
    members_of,
    operation_name,
    table_of,
)
from changelake.schemas import DELETE, INSERT, META_COLUMNS, OPERATION_CODES, REGISTRY, SNAPSHOT, UPDATE

TABLE_MEMBER = "__table__"

# The columns that say where a body came from.
ORIGIN = ("source", "position")

DATA, PROGRESS, DEAD = "data", "progress", "dead"

# Members with a type other than text, of all registered tables.
TYPED_MEMBERS = tuple(dict.fromkeys(f.name for spec in REGISTRY.values() for f in spec.columns.fields if f.dataType.typeName() != "string"))

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

ROW_COLUMNS = ("feed", *META_COLUMNS, "cdc_ts", "cdc_seq", "row")


@dataclass(frozen=True)
class Normalized:
    """What a feed contained.

    ``rows``      one per change, the row image still a VARIANT in ``row``
    ``progress``  one per resolved marker: feed, resolved, resolved_ts
    ``dead``      one per event that is not a change: feed, reason, body
    """

    rows: DataFrame
    progress: DataFrame
    dead: DataFrame


def unpack(raw: DataFrame) -> DataFrame:
    """One row per event: feed, event, the batch's own table name, bad body text.

    The body text itself is kept only where it is not JSON; otherwise a large
    batch would be copied into every event taken from it.  Where a body came from
    (``source``, ``position``) goes with its events if the feed says so.
    """
    origin = _origin(raw)
    feed = F.col("feed") if "feed" in raw.columns else F.lit("default")
    arrived = F.date_format("received_at", TIME_FORMAT) if "received_at" in raw.columns else F.lit(None).cast("string")
    body = F.col("_body")

    def events_of(v: Column) -> Column:
        return F.coalesce(F.try_variant_get(v, "$.payload", "array<variant>"), F.array(v))

    listed = F.transform(F.try_variant_get(body, "$", "array<variant>"), events_of)
    return (
        raw.select(feed.alias("feed"), *origin, arrived.alias("arrived"), "value", F.try_parse_json("value").alias("_body"))
        .select(
            "feed",
            *origin,
            "arrived",
            "_body",
            F.when(body.isNull(), F.col("value")).alias("bad_text"),
            field(body, TABLE_MEMBER, "string").alias("batch_table"),
        )
        .select("feed", *origin, "arrived", "bad_text", "batch_table", F.explode(F.coalesce(F.flatten(listed), events_of(body))).alias("event"))
    )


def _origin(df: DataFrame) -> list[str]:
    return [c for c in ORIGIN if c in df.columns]


# Members of an event and of a nested envelope that decide what they are.
ENVELOPE_MEMBERS = "after:variant,before:variant,op:string,ts_ms:string,source:struct<table:string>"
EVENT_MEMBERS = f"payload:variant,{TABLE_MEMBER}:string,updated:string,resolved:string,{ENVELOPE_MEMBERS}"


def _shape() -> Column:
    """Which kind of envelope an event is, most specific first."""
    outer = F.col("outer")
    images = outer["after"].isNotNull() | outer["before"].isNotNull()
    return (
        F.when(F.col("event").isNull(), F.lit("invalid"))
        .when(images & outer["op"].isin(*OPERATION_CODES), F.lit("coded_flat"))
        .when(outer["after"].isNotNull(), F.lit("pair"))
        .when(F.col("inner").isNotNull(), F.lit("coded"))
        .otherwise(F.lit("bare"))
    )


def _at_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Select columns behind a generator, where no later filter is pushed.

    Predicates on derived columns would otherwise be rewritten in terms of the
    raw event, repeating the whole derivation inside every filter.
    """
    return df.select(F.explode(F.array(F.struct(*columns))).alias("_one")).select("_one.*")


def classify(events: DataFrame, ingest_ts: Column | str | None = None) -> DataFrame:
    """Decide kind, table, operation, time and row image of every event.

    Members are read in one pass per object: each separate lookup costs as much.  What only
    stored rows need is derived last, so that a query that does not ask for it does not pay.
    """
    shape, event, size = F.col("shape"), F.col("event"), F.col("size")
    outer, inner = F.col("outer"), F.col("inner")
    after, before, row = F.col("after"), F.col("before"), F.col("row")
    has_after, has_before = F.col("has_after"), F.col("has_before")
    is_coded, pair, bare, removed = F.col("is_coded"), shape == "pair", shape == "bare", F.col("removed")

    def of_envelope(name: str) -> Column:
        return F.when(shape == "coded", inner[name]).otherwise(outer[name])

    opened = (
        events.withColumn("outer", F.try_variant_get(event, "$", f"struct<{EVENT_MEMBERS}>"))
        .withColumn("inner", F.try_variant_get(outer["payload"], "$", f"struct<{ENVELOPE_MEMBERS}>"))
        .withColumn("shape", _shape())
        .withColumns(
            {
                "size": F.when(bare, F.coalesce(F.size(members(event)), F.lit(-1))),
                "is_coded": shape.isin("coded", "coded_flat"),
                "after": of_envelope("after"),
                "before": of_envelope("before"),
            }
        )
        .withColumns({"has_after": is_truthy(after), "has_before": is_truthy(before), "removed": is_json_null(after)})
    )
    image = F.when(bare, event).when(has_after, after).when(has_before & (is_coded | (pair & removed)), before)
    op = (
        F.when(bare, F.lit(SNAPSHOT))
        .when(is_coded, operation_name(F.col("code")))
        .when(removed, F.lit(DELETE))
        .when(has_before, F.lit(UPDATE))
        .otherwise(F.lit(INSERT))
    )
    reason = (
        F.when(bare & (size > 0) | has_after, F.lit(None).cast("string"))
        .when(shape == "invalid", F.lit("invalid_json"))
        .when(bare & (size == 0), F.lit("empty_row"))
        .when(bare & is_json_null(event), F.lit("null_body"))
        .when(bare, F.lit("not_an_object"))
        .when(is_coded & ~has_before, F.lit("no_row_image"))
        .when(pair & removed & ~has_before, F.lit("delete_without_before"))
        .when(pair & ~removed & is_object(after), F.lit("empty_after"))
        .when(pair & ~removed, F.lit("row_not_an_object"))
    )
    named = F.coalesce(
        outer[TABLE_MEMBER],
        F.when(is_coded, of_envelope("source")["table"]),
        F.col("batch_table"),
    )
    own_time = F.coalesce(
        F.when(is_coded, of_envelope("ts_ms")), F.when(~bare, outer["updated"])
    )
    origin = [F.col(c) for c in _origin(events)]
    described = _at_once(
        opened.withColumn("code", of_envelope("op")),
        F.col("feed"),
        *origin,
        F.coalesce(_given(ingest_ts), F.col("arrived"), F.date_format(F.current_timestamp(), TIME_FORMAT)).alias("ingest_text"),
        F.col("bad_text"),
        event,
        F.when(bare & (size == 1), outer["resolved"]).alias("resolved"),
        reason.alias("reason"),
        op.alias("cdc_operation"),
        image.alias("row"),
        named.alias("named_table"),
        own_time.alias("own_time"),
    )
    held = F.col("held")
    judged = described.withColumn("held", members_of(row, (*IDENTIFYING, *TYPED_MEMBERS))).select(
        "feed",
        *origin,
        "ingest_text",
        "bad_text",
        "event",
        "resolved",
        "reason",
        "cdc_operation",
        "row",
        "held",
        F.coalesce("named_table", table_of(held)).alias("cdc_table"),
        F.coalesce(F.nullif("own_time", F.lit("")), "ingest_text").alias("cdc_timestamp"),
    ).withColumn("reason", F.coalesce("reason", _uncastable(held)))
    kind = (
        F.when(F.col("resolved").isNotNull(), F.lit(PROGRESS))
        .when(F.col("reason").isNotNull(), F.lit(DEAD))
        .otherwise(F.lit(DATA))
    )
    time = F.col("cdc_timestamp")
    decided = _at_once(
        judged,
        F.col("feed"),
        *origin,
        kind.alias("kind"),
        F.col("reason"),
        *[F.col(c) for c in META_COLUMNS],
        F.col("ingest_text"),
        row,
        F.col("resolved"),
        F.col("bad_text"),
        event,
    )
    return decided.select(
        "feed",
        *origin,
        "kind",
        "reason",
        *META_COLUMNS,
        # A time nobody can read gives way to the ingest time, as a missing one does.
        F.coalesce(event_time(time), event_time(F.col("ingest_text"))).alias("cdc_ts"),
        event_seq(time).alias("cdc_seq"),
        "row",
        "resolved",
        F.when(F.col("reason").isNotNull(), F.coalesce("bad_text", F.to_json("event"))).alias("body"),
    )


def _given(ingest_ts: Column | str | None) -> Column:
    """The caller's fallback change time; without it the body's arrival, then the query's start, stands in."""
    return ingest_ts if isinstance(ingest_ts, Column) else F.lit(ingest_ts).cast("string")


def _uncastable(held: Column) -> Column:
    """Reason for the first typed column whose value cannot be read as its type."""
    out = F.lit(None).cast("string")
    for table, spec in REGISTRY.items():
        for f in reversed(spec.columns.fields):
            if f.dataType.typeName() == "string":
                continue
            given = held[f.name]
            bad = given.isNotNull() & ~is_json_null(given) & F.try_variant_get(given, "$", f.dataType.simpleString()).isNull()
            out = F.when((F.col("cdc_table") == table) & bad, F.lit(f"uncastable_{f.name}")).otherwise(out)
    return out


def split(classified: DataFrame) -> Normalized:
    """The three outcomes of a classified feed."""
    kind = F.col("kind")
    return Normalized(
        rows=classified.filter(kind == DATA).select(*ROW_COLUMNS),
        progress=classified.filter(kind == PROGRESS).select(
            "feed", "resolved", event_time(F.col("resolved")).alias("resolved_ts")
        ),
        dead=classified.filter(kind == DEAD).select("feed", "reason", "body"),
    )


def normalize(raw: DataFrame, ingest_ts: Column | str | None = None) -> Normalized:
    """Rows, progress markers and dead letters of a feed."""
    return split(classify(unpack(raw), ingest_ts))


def normalize_once(raw: DataFrame, path: str, ingest_ts: Column | str | None = None) -> Normalized:
    """The same, stored at ``path`` first: outcomes that are used several times are parsed once."""
    classify(unpack(raw), ingest_ts).write.parquet(path)
    return split(raw.sparkSession.read.parquet(path))


def progress(markers: DataFrame) -> DataFrame:
    """How far each feed is resolved."""
    return markers.groupBy("feed").agg(F.max("resolved_ts").alias("resolved_ts"))


def consistent_cut(rows: DataFrame, markers: DataFrame) -> DataFrame:
    """Rows no later than what their feed has resolved.

    The feeds' times, one per feed, are one map value; rows are not shuffled.
    """
    known = progress(markers).filter(F.col("feed").isNotNull())
    resolved = known.agg(F.map_from_entries(F.collect_list(F.struct("feed", "resolved_ts"))).alias("resolved")).scalar()
    return rows.filter(F.col("cdc_ts") <= F.try_element_at(resolved, F.col("feed")))
