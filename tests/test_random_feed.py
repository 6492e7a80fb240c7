"""Random feeds whose outcome is known by construction."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from changelake.operators import envelope as N
from changelake.operators import shaping as T

INGEST = "2024-06-01T00:00:00+00:00"
OPS = {"insert": "c", "update": "u", "delete": "d", "snapshot": "r"}

IDENTITY = {
    "expenses": ("expense_id",),
    "order": ("o_id", "o_c_id"),
    "order_line": ("ol_o_id",),
    "new_order": ("no_o_id",),
    "customer": ("c_id", "c_w_id"),
    "district": ("d_id", "d_w_id", "d_name"),
    "warehouse": ("w_id", "w_name"),
    "stock": ("s_i_id", "s_w_id"),
    "item": ("i_id", "i_name"),
    "history": ("h_c_id",),
    "unknown": ("something",),
}


def image(rng, table, number):
    names = IDENTITY[table]
    return {names[0]: f"{table}-{number}", **{n: rng.randint(0, 9) for n in names[1:]}, "extra": rng.choice([None, 1.5, True, [1], "x"])}


def change(rng, number):
    """An event and the (table, operation, key, time) it stands for."""
    table = rng.choice(list(IDENTITY))
    row = image(rng, table, number)
    key = row[IDENTITY[table][0]]
    shape = rng.choice(["pair", "coded", "flat", "bare"])
    if shape == "bare":
        return row, (table, "snapshot", key, INGEST)
    op = rng.choice(["insert", "update", "delete"] if shape == "pair" else list(OPS))
    before = row if op == "delete" else ({"old": 1} if op == "update" else rng.choice([None, {}]))
    after = None if op == "delete" else row
    if shape == "pair":
        time = f"{rng.randint(1, 9)}000000000.{rng.randint(0, 99):010d}"
        return {"before": before, "after": after, "updated": time}, (table, op, key, time)
    millis = rng.randint(1, 10**12)
    event = {"op": OPS[op], "before": before, "after": after, "ts_ms": millis}
    return (event if shape == "flat" else {"payload": event}), (table, op, key, str(millis))


def mistake(rng, number):
    """An event that is no change, and why."""
    return rng.choice(
        [
            ({"after": None}, "delete_without_before"),
            ({"after": {}}, "empty_after"),
            ({"after": number}, "row_not_an_object"),
            ({"payload": {"op": "u", "after": None}}, "no_row_image"),
            ({}, "empty_row"),
            (number, "not_an_object"),
            ({"after": {"expense_id": "e", "expense_amount": "lots"}}, "uncastable_expense_amount"),
        ]
    )


def bodies(rng, events):
    """The events in order, packed into single, list and batch bodies."""
    out, at = [], 0
    while at < len(events):
        size = rng.randint(1, 5)
        chunk = events[at : at + size]
        at += size
        out.append(json.dumps(rng.choice([chunk, {"payload": chunk}] if len(chunk) > 1 else [chunk, {"payload": chunk}, chunk[0]])))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_feed(spark, seed):
    rng = random.Random(seed)
    events, rows, reasons = [], Counter(), Counter()
    for number in range(400):
        if rng.random() < 0.2:
            event, reason = mistake(rng, number)
            reasons[reason] += 1
        else:
            event, outcome = change(rng, number)
            rows[outcome] += 1
        events.append(event)
    raw = spark.createDataFrame([(b,) for b in bodies(rng, events)], "value string").repartition(4)
    found = N.normalize(raw, INGEST)
    key = F.coalesce(*[F.try_variant_get("row", f"$.{names[0]}", "string") for names in IDENTITY.values()])
    got = found.rows.select("cdc_table", "cdc_operation", key, "cdc_timestamp").collect()
    assert Counter(tuple(r) for r in got) == rows
    assert Counter(r.reason for r in found.dead.select("reason").collect()) == reasons
    routed = T.route(found.rows)
    for table, df in routed.items():
        assert df.count() == sum(n for (t, *_), n in rows.items() if t == table)
