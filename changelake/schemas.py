"""One registry for every captured table: columns, keys, namespace, layout.

Amounts are DECIMAL(12,2) inside the library; reports expose them as DOUBLE.
The order-entry tables are kept as text, as their change feed delivers them,
and are cast where a report needs a number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names and formats that belong to the change-feed data itself.
# ---------------------------------------------------------------------------
META_COLUMNS = ("cdc_table", "cdc_operation", "cdc_timestamp")

INSERT, UPDATE, DELETE, SNAPSHOT, UNKNOWN = "insert", "update", "delete", "snapshot", "unknown"

OPERATION_CODES = {"c": INSERT, "u": UPDATE, "d": DELETE, "r": SNAPSHOT}

# Bookkeeping columns a raw Parquet changefeed adds to every row.
RAW_EVENT_TYPE = "__crdb__event_type"
RAW_UPDATED = "__crdb__updated"
RAW_BEFORE = "__crdb__before"

# A row belongs to the first table whose listed columns are all present.
DETECTION_RULES = (
    ("expenses", ("expense_id",)),
    ("order", ("o_id", "o_c_id")),
    ("order_line", ("ol_o_id",)),
    ("new_order", ("no_o_id",)),
    ("customer", ("c_id", "c_w_id")),
    ("district", ("d_id", "d_w_id", "d_name")),
    ("warehouse", ("w_id", "w_name")),
    ("stock", ("s_i_id", "s_w_id")),
    ("item", ("i_id", "i_name")),
    ("history", ("h_c_id",)),
)

AMOUNT = T.DecimalType(12, 2)

EXPENSES = T.StructType(
    [
        T.StructField("expense_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("expense_amount", AMOUNT),
        T.StructField("expense_date", T.StringType()),
        T.StructField("shopping_type", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("recurring", T.BooleanType()),
    ]
)

ORDER_ENTRY_COLUMNS = {
    "warehouse": "w_id w_name w_street_1 w_street_2 w_city w_state w_zip w_tax w_ytd",
    "district": "d_id d_w_id d_name d_street_1 d_street_2 d_city d_state d_zip d_tax d_ytd d_next_o_id",
    "customer": "c_id c_d_id c_w_id c_first c_middle c_last c_street_1 c_street_2 c_city c_state "
    "c_zip c_phone c_since c_credit c_credit_lim c_discount c_balance c_ytd_payment "
    "c_payment_cnt c_delivery_cnt c_data",
    "order": "o_id o_d_id o_w_id o_c_id o_entry_d o_carrier_id o_ol_cnt o_all_local",
    "order_line": "ol_o_id ol_d_id ol_w_id ol_number ol_i_id ol_supply_w_id ol_delivery_d "
    "ol_quantity ol_amount ol_dist_info",
    "new_order": "no_o_id no_d_id no_w_id",
    "item": "i_id i_im_id i_name i_price i_data",
    "stock": "s_i_id s_w_id s_quantity s_dist_01 s_dist_02 s_dist_03 s_dist_04 s_dist_05 "
    "s_dist_06 s_dist_07 s_dist_08 s_dist_09 s_dist_10 s_ytd s_order_cnt s_remote_cnt s_data",
    "history": "rowid h_c_id h_c_d_id h_c_w_id h_d_id h_w_id h_date h_amount h_data",
}

ORDER_ENTRY_KEYS = {
    "warehouse": ("w_id",),
    "district": ("d_w_id", "d_id"),
    "customer": ("c_w_id", "c_d_id", "c_id"),
    "order": ("o_w_id", "o_d_id", "o_id"),
    "order_line": ("ol_w_id", "ol_d_id", "ol_o_id", "ol_number"),
    "new_order": ("no_w_id", "no_d_id", "no_o_id"),
    "item": ("i_id",),
    "stock": ("s_w_id", "s_i_id"),
    "history": ("rowid",),
}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """What the library knows about one captured table."""

    name: str
    namespace: str
    columns: T.StructType
    keys: tuple[str, ...]
    partition_by: tuple[str, ...] = ()

    @property
    def log_schema(self) -> T.StructType:
        """Source columns, the three change columns, the parsed event time, and further members of all-text tables."""
        meta = [T.StructField(c, T.StringType()) for c in META_COLUMNS]
        order = [T.StructField("cdc_ts", T.TimestampType()), T.StructField("cdc_seq", T.LongType())]
        rest = [T.StructField("rest", T.MapType(T.StringType(), T.StringType()))] if is_text_table(self) else []
        return T.StructType(list(self.columns.fields) + meta + order + rest)


def is_text_table(spec: TableSpec) -> bool:
    return all(isinstance(f.dataType, T.StringType) for f in spec.columns.fields)


def _text_columns(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


REGISTRY: dict[str, TableSpec] = {
    "expenses": TableSpec("expenses", "spending", EXPENSES, ("expense_id",), ("shopping_type",)),
    **{
        name: TableSpec(name, "order_entry", _text_columns(cols), ORDER_ENTRY_KEYS[name])
        for name, cols in ORDER_ENTRY_COLUMNS.items()
    },
}


def default_for(data_type: T.DataType):
    """Value that stands in for a missing source column of this type."""
    if isinstance(data_type, T.BooleanType):
        return False
    if isinstance(data_type, T.NumericType):
        return 0
    return ""
