"""Edge events of every envelope, one at a time."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changelake.operators import envelope as N
from changelake.operators import shaping as T
from changelake.sources import kafka

INGEST = "2024-06-01T00:00:00+00:00"

ROW = {
    "expense_id": "e1",
    "user_id": "u1",
    "description": "Coffee",
    "merchant": "Cafe",
    "expense_amount": 5.50,
    "expense_date": "2025-03-01",
    "shopping_type": "Coffee",
    "payment_method": "Debit Card",
    "recurring": False,
}


def feed(spark, *bodies):
    texts = [b if isinstance(b, str) or b is None else json.dumps(b) for b in bodies]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def rows(spark, *bodies):
    found = N.normalize(feed(spark, *bodies), INGEST).rows
    return found.select("cdc_table", "cdc_operation", "cdc_timestamp", F.to_json("row").alias("row")).collect()


def dead(spark, *bodies):
    return [r.reason for r in N.normalize(feed(spark, *bodies), INGEST).dead.collect()]


def expenses(spark, *bodies):
    return T.typed_rows(N.normalize(feed(spark, *bodies), INGEST).rows, "expenses").collect()


@pytest.mark.parametrize(
    "body, op",
    [
        ({"after": ROW}, "insert"),
        ({"before": None, "after": ROW}, "insert"),
        ({"before": {}, "after": ROW}, "insert"),
        ({"before": {"expense_id": "e1"}, "after": ROW}, "update"),
        ({"before": ROW, "after": None}, "delete"),
        ({"payload": {"op": "c", "after": ROW}}, "insert"),
        ({"payload": {"op": "u", "before": ROW, "after": ROW}}, "update"),
        ({"payload": {"op": "d", "before": ROW, "after": None}}, "delete"),
        ({"payload": {"op": "r", "after": ROW}}, "snapshot"),
        ({"payload": {"op": "x", "after": ROW}}, "unknown"),
        ({"payload": {"after": ROW}}, "unknown"),
        ({"op": "r", "before": None, "after": ROW}, "snapshot"),
        ({"op": "d", "before": ROW}, "delete"),
        (ROW, "snapshot"),
    ],
)
def test_operation(spark, body, op):
    (row,) = rows(spark, body)
    assert (row.cdc_table, row.cdc_operation) == ("expenses", op)
    assert json.loads(row.row)["expense_id"] == "e1"


@pytest.mark.parametrize(
    "body, reason",
    [
        ("{not json", "invalid_json"),
        ("null", "null_body"),
        ("5", "not_an_object"),
        ('"text"', "not_an_object"),
        ({}, "empty_row"),
        ({"after": None}, "delete_without_before"),
        ({"before": {}, "after": None}, "delete_without_before"),
        ({"after": {}}, "empty_after"),
        ({"before": ROW, "after": {}}, "empty_after"),
        ({"after": 7}, "row_not_an_object"),
        ({"payload": {"op": "d"}}, "no_row_image"),
        ({"payload": {}}, "no_row_image"),
        ({"after": {**ROW, "expense_amount": "much"}}, "uncastable_expense_amount"),
        ({"after": {**ROW, "recurring": "perhaps"}}, "uncastable_recurring"),
    ],
)
def test_dead_letter(spark, body, reason):
    assert dead(spark, body) == [reason]
    assert rows(spark, body) == []


def test_absent_body_is_a_dead_letter_without_text(spark):
    (letter,) = N.normalize(feed(spark, None), INGEST).dead.collect()
    assert (letter.reason, letter.body) == ("invalid_json", None)


def test_invalid_text_is_kept(spark):
    (letter,) = N.normalize(feed(spark, "{broken"), INGEST).dead.collect()
    assert letter.body == "{broken"


def test_before_without_after_is_a_bare_row(spark):
    (row,) = rows(spark, {"before": {"a": 1}})
    assert (row.cdc_table, row.cdc_operation) == ("unknown", "snapshot")


def test_batches_and_lists_are_unpacked(spark):
    body = {"payload": [{"after": ROW}, {"before": ROW, "after": None}, {"after": None}]}
    assert sorted(r.cdc_operation for r in rows(spark, body)) == ["delete", "insert"]
    assert sorted(r.cdc_operation for r in rows(spark, [{"after": ROW}, body])) == ["delete", "insert", "insert"]
    assert dead(spark, body) == ["delete_without_before"]
    assert rows(spark, [], {"payload": []}) == []


def test_table_override(spark):
    assert rows(spark, {"__table__": "item", "after": ROW})[0].cdc_table == "item"
    assert rows(spark, {"__table__": "things", "a": 1})[0].cdc_table == "things"
    assert rows(spark, {"__table__": "things", "payload": [{"after": {"a": 1}}]})[0].cdc_table == "things"
    coded = {"payload": {"op": "c", "after": {"a": 1}, "source": {"table": "stock"}}}
    assert rows(spark, coded)[0].cdc_table == "stock"


@pytest.mark.parametrize(
    "row, table",
    [
        ({"o_id": 1, "o_c_id": 2}, "order"),
        ({"o_id": 1}, "unknown"),
        ({"ol_o_id": 1}, "order_line"),
        ({"no_o_id": 1}, "new_order"),
        ({"c_id": 1, "c_w_id": 1}, "customer"),
        ({"d_id": 1, "d_w_id": 1, "d_name": None}, "district"),
        ({"w_id": 1, "w_name": "w"}, "warehouse"),
        ({"s_i_id": 1, "s_w_id": 1}, "stock"),
        ({"i_id": 1, "i_name": "i"}, "item"),
        ({"h_c_id": 1}, "history"),
    ],
)
def test_detection(spark, row, table):
    assert rows(spark, {"after": row})[0].cdc_table == table


def test_typed_values(spark):
    body = {"after": {**ROW, "expense_amount": "12.345", "recurring": "false", "user_id": None, "merchant": {"n": [1]}}}
    (row,) = expenses(spark, body)
    assert row.expense_amount == Decimal("12.35")
    assert row.recurring is False
    assert row.user_id is None
    assert json.loads(row.merchant) == {"n": [1]}


def test_missing_members_take_defaults_and_nulls_stay(spark):
    (row,) = expenses(spark, {"after": {"expense_id": "e2", "expense_amount": None, "recurring": 1}})
    assert (row.user_id, row.description, row.expense_amount, row.recurring) == ("", "", None, True)


def test_text_tables_have_no_nulls(spark):
    found = N.normalize(feed(spark, {"o_id": 1, "o_c_id": 2.5, "o_all_local": True, "o_carrier_id": None}), INGEST)
    (row,) = T.typed_rows(found.rows, "order").collect()
    assert (row.o_id, row.o_c_id, row.o_all_local, row.o_carrier_id, row.o_d_id) == ("1", "2.5", "true", "", "")


def test_duplicates_and_equal_times_all_stay(spark):
    body = {"after": ROW, "updated": "1000.1"}
    assert len(rows(spark, body, body)) == 2


@pytest.mark.parametrize(
    "text, ts, seq",
    [
        ("1700000000000000123.0000000005", datetime(2023, 11, 14, 22, 13, 20), 123 * 10**10 + 5),
        ("800000000000000000.0000000000", datetime(1995, 5, 9, 6, 13, 20), 0),
        ("1700000000000", datetime(2023, 11, 14, 22, 13, 20), 0),
        ("2023-11-14T22:13:20+00:00", datetime(2023, 11, 14, 22, 13, 20), 0),
        ("not a time", datetime(2024, 6, 1), 0),  # the ingest time stands in
    ],
)
def test_event_time(spark, text, ts, seq):
    found = N.normalize(feed(spark, {"after": ROW, "updated": text}), INGEST).rows
    (row,) = found.select("cdc_timestamp", "cdc_ts", "cdc_seq").collect()
    assert (row.cdc_timestamp, row.cdc_ts, row.cdc_seq) == (text, ts, seq)


def test_time_falls_back_to_ingest(spark):
    assert rows(spark, {"after": ROW, "updated": ""})[0].cdc_timestamp == INGEST
    assert rows(spark, {"payload": {"op": "c", "after": ROW, "ts_ms": 1000}})[0].cdc_timestamp == "1000"


def test_resolved_markers_are_progress_only(spark):
    found = N.normalize(feed(spark, {"resolved": "2000000000.0000000000"}, {"after": ROW, "updated": "1000000000.0"}), INGEST)
    (marker,) = found.progress.collect()
    assert marker.resolved_ts == datetime(1970, 1, 1, 0, 0, 2)
    assert found.rows.count() == 1 and found.dead.count() == 0
    assert N.consistent_cut(found.rows, found.progress).count() == 1
    row_with_such_a_column = {"ticket": 1, "resolved": True}
    assert rows(spark, row_with_such_a_column)[0].cdc_table == "unknown"


def test_inferred_schema_looks_at_every_row(spark):
    bodies = [{"__table__": "t", "a": 1, "n": None}, {"__table__": "t", "a": 1.5, "b": True, "c": {"d": 1}}, {"__table__": "t", "a": 2, "b": "x"}]
    found = T.inferred_rows(N.normalize(feed(spark, *bodies), INGEST).rows, "t")
    types = dict(found.dtypes)
    assert (types["a"], types["b"], types["c"], types["n"]) == ("double", "string", "string", "string")
    assert sorted(r.a for r in found.collect()) == [1.0, 1.5, 2.0]
    assert sorted(r.b for r in found.collect()) == ["", "true", "x"]


def test_text_map_keeps_every_member(spark):
    found = T.text_map_rows(N.normalize(feed(spark, {"__table__": "t", "a": 1, "b": None, "c": [1]}), INGEST).rows)
    assert found.first().members == {"a": "1", "b": "", "c": "[1]"}


def test_binary_messages(spark):
    messages = spark.createDataFrame(
        [("topic-a", bytearray(json.dumps({"after": ROW}), "utf8")), ("topic-a", None)], "topic string, value binary"
    )
    found = N.normalize(kafka.decode(messages), INGEST)
    assert found.rows.first().feed == "topic-a"
    assert found.dead.count() == 1


def test_kafka_options():
    chosen = kafka.options("b1:9092,b2:9092", ["x", "y"], max_offsets=500)
    assert chosen["subscribe"] == "x,y" and chosen["startingOffsets"] == "earliest"
    assert chosen["maxOffsetsPerTrigger"] == "500"
    with pytest.raises(ValueError):
        kafka.options("b", [])


def test_normalizing_needs_no_shuffle(spark):
    found = N.normalize(feed(spark, {"after": ROW}), INGEST)
    plan = T.typed_rows(found.rows, "expenses")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_a_mixed_feed_is_routed(spark):
    mixed = N.normalize(feed(spark, {"after": ROW}, {"w_id": 1, "w_name": "n"}, {"i_id": 5, "i_name": "x"}, {"q": 1}), INGEST)
    routed = T.route(mixed.rows, ["expenses", "warehouse", "item", "stock"])
    assert {t: df.count() for t, df in routed.items()} == {"expenses": 1, "warehouse": 1, "item": 1, "stock": 0}
    assert routed["item"].first().i_price == ""


def test_times_beyond_all_calendars_never_fail_a_batch(spark):
    from changelake.functions.event_time import event_seq, event_time
    from pyspark.sql import functions as F

    texts = ["1700000000000000000", "-9" * 9, "1700000000000000000.9223372036854775807", "-9223372036854775808.1", "9" * 30, "9" * 30 + ".1", "later", "1700000000000"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", event_time(F.col("t")).alias("ts"), event_seq(F.col("t")).alias("seq")).collect()
    found = {r.t: r for r in rows}
    assert found[texts[0]].ts is None and found[texts[4]].ts is None and found["later"].ts is None
    assert found[texts[2]].ts is not None and found["1700000000000"].ts is not None


def test_members_with_odd_names_are_inferred(spark):
    found = T.inferred_rows(N.normalize(feed(spark, {"__table__": "t", "it's": 1, "OBJECT<": 2, "a.b": "x"}), INGEST).rows, "t")
    row = found.first()
    assert (row["it's"], row["OBJECT<"], row["a.b"]) == (1, 2, "x")


def test_arrival_stands_in_for_a_missing_time(spark):
    raw = feed(spark, {"after": ROW}).withColumn("received_at", F.lit("2024-02-03T04:05:06Z").cast("timestamp"))
    assert N.normalize(raw).rows.select(F.col("cdc_ts") == F.lit("2024-02-03T04:05:06Z").cast("timestamp")).first()[0]


def test_inferred_members_with_clashing_names(spark, tmp_path):
    bodies = [{"__table__": "t", "CDC_TS": 1, "a": 2, "A": "x", "a_2": 3, "cdc_table": "mine"}, {"__table__": "t", "a": 4}]
    found = T.inferred_rows(N.normalize(feed(spark, *bodies), INGEST).rows, "t")
    found.write.parquet(str(tmp_path / "t"))
    rows = {r.a_3: r for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert (rows[2].A, rows[2].a_2, rows[2].CDC_TS_2, rows[2].cdc_table_2, rows[2].cdc_table) == ("x", 3, 1, "mine", "t")
    assert (rows[4].A, rows[4].a_2, rows[4].CDC_TS_2, rows[4].cdc_table_2) == ("", 0, 0, "")
    assert T.column_names(["b", "B", "b_2", "cdc_seq"]) == ["b_3", "B", "b_2", "cdc_seq_2"]


def test_members_used_as_data_are_refused(spark, monkeypatch):
    monkeypatch.setattr(T, "MOST_COLUMNS", 2)
    rows = N.normalize(feed(spark, *({"__table__": "t", f"k{i}": i} for i in range(3))), INGEST).rows
    with pytest.raises(ValueError, match="text maps"):
        T.inferred_rows(rows, "t")
    assert T.text_map_rows(rows).count() == 3
