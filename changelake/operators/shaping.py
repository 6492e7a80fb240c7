"""Normalized rows -> the columns of one table.

Known tables take their columns from the registry.  A missing member becomes
the column's default; an explicit JSON null stays NULL in typed tables and
becomes an empty text in the all-text tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.rows import members, present
from changelake.operators.envelope import TABLE_MEMBER
from changelake.schemas import META_COLUMNS, REGISTRY, TableSpec, default_for, is_text_table

TIME_COLUMNS = ("cdc_ts", "cdc_seq")
MOST_COLUMNS = 5_000  # of an inferred table


def _value(spec: TableSpec, f: T.StructField) -> Column:
    value = F.col(f"_row.{f.name}")
    default = F.lit(default_for(f.dataType)).cast(f.dataType)
    missing = F.lit(True) if is_text_table(spec) else ~present(F.col("row"), f.name)
    return F.coalesce(value, F.when(missing, default)).alias(f.name)


def typed_rows(rows: DataFrame, table: str) -> DataFrame:
    """The rows of one registered table as its columns plus change columns.

    All members are read in one pass over the row image.
    """
    spec = REGISTRY[table]
    opened = rows.filter(F.col("cdc_table") == table).withColumn(
        "_row", F.try_variant_get("row", "$", spec.columns.simpleString())
    )
    carried = [c for c in ("feed",) if c in rows.columns]
    return opened.select(*[_value(spec, f) for f in spec.columns.fields], *META_COLUMNS, *TIME_COLUMNS, *_rest(spec), *carried)


def _rest(spec: TableSpec) -> list[Column]:
    """Members of an all-text table that the registry does not list, as a map."""
    return [_text_map(TABLE_MEMBER, *spec.columns.fieldNames()).alias("rest")] if is_text_table(spec) else []


def _text_map(*without: str) -> Column:
    texts = F.transform_values(F.try_variant_get("row", "$", "map<string,string>"), lambda _, v: F.coalesce(v, F.lit("")))
    return F.map_filter(texts, lambda name, _: ~name.isin(*without))


def route(rows: DataFrame, tables: list[str] | None = None) -> dict[str, DataFrame]:
    """One DataFrame per registered table out of a mixed feed."""
    return {t: typed_rows(rows, t) for t in (tables or REGISTRY)}


def text_map_rows(rows: DataFrame) -> DataFrame:
    """Rows of any table, every member as text in one map column."""
    return rows.select(_text_map(TABLE_MEMBER).alias("members"), *META_COLUMNS, *TIME_COLUMNS)


def all_strings(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def fill_defaults(df: DataFrame, table: str) -> DataFrame:
    """NULLs of a registered table replaced by the column defaults."""
    types = {f.name: f.dataType for f in REGISTRY[table].columns.fields}
    return df.select(
        *[F.coalesce(c, F.lit(default_for(types[c])).cast(types[c])).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def _column_type(name: str) -> T.DataType:
    """Inferred member type -> column type: flag, whole number, number or text."""
    if name == "BOOLEAN":
        return T.BooleanType()
    if name == "BIGINT" or name.startswith("DECIMAL") and name.endswith(",0)"):
        return T.LongType()
    return T.DoubleType() if name.startswith(("DECIMAL", "DOUBLE", "FLOAT")) else T.StringType()


def infer_schema(rows: DataFrame) -> T.StructType:
    """Column types over all rows, widened where rows disagree.

    One aggregate per member name; only the names and merged types come back.  A table with
    more than ``MOST_COLUMNS`` names uses its members as data and is refused:
    ``text_map_rows`` keeps such rows.
    """
    each = rows.select(F.explode(members(F.col("row"))).alias("name", "value")).filter(F.col("name") != TABLE_MEMBER)
    merged = each.groupBy("name").agg(F.schema_of_variant_agg("value").alias("type")).limit(MOST_COLUMNS + 1).collect()
    if len(merged) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} member names: keep these rows as text maps")
    merged.sort(key=lambda r: r["name"])
    return T.StructType([T.StructField(r["name"], _column_type(r["type"])) for r in merged])


def column_names(names: list[str]) -> list[str]:
    """A column name for each member, all different whatever their case.

    The change columns keep theirs, and of members that differ in case only the first in
    code-point order does; any other gets the first of ``_2``, ``_3``, ... that nobody has.
    """
    given = {n.lower() for n in names}
    used = {c.lower() for c in (*META_COLUMNS, *TIME_COLUMNS)}
    chosen = {}
    for name in sorted(names):
        shown, k = name, 1
        while shown.lower() in used or k > 1 and shown.lower() in given:
            k += 1
            shown = f"{name}_{k}"
        used.add(shown.lower())
        chosen[name] = shown
    return [chosen[n] for n in names]


def _typed_members(own: DataFrame, types: T.StructType) -> DataFrame:
    """One column per member of ``types``; missing and null values take the column default."""
    columns = []
    for f, shown in zip(types.fields, column_names([f.name for f in types.fields])):
        value = F.try_variant_get(F.try_element_at("_members", F.lit(f.name)), "$", f.dataType.simpleString())
        columns.append(F.coalesce(value, F.lit(default_for(f.dataType)).cast(f.dataType)).alias(shown))
    return own.withColumn("_members", members(F.col("row"))).select(*columns, *[c for c in own.columns if c != "row"])


def inferred_rows(rows: DataFrame, table: str) -> DataFrame:
    """Rows of an unregistered table with columns inferred from the whole batch.

    Missing and null values take the column default.  Members with the names of change
    columns, or with names that differ in case only, are told apart by ``column_names``.
    """
    own = rows.filter(F.col("cdc_table") == table)
    return _typed_members(own.select("row", *META_COLUMNS, *TIME_COLUMNS), infer_schema(own))


# The types a member of one batch can have; void is one that was always null.
NUMBERS, VOID = ("bigint", "double"), "void"


def member_types(rows: DataFrame) -> DataFrame:
    """``cdc_table, name, type``: what every member of a batch holds, widened where its rows disagree.

    Two-phase, one row per table and member, so that it can be kept with a commit and
    merged with those of others.
    """
    each = rows.select("cdc_table", F.explode(members(F.col("row"))).alias("name", "value")).filter(F.col("name") != TABLE_MEMBER)
    found = each.groupBy("cdc_table", "name").agg(F.schema_of_variant_agg("value").alias("seen"))
    seen = F.col("seen")
    kind = (
        F.when(seen == "BOOLEAN", F.lit("boolean"))
        .when((seen == "BIGINT") | seen.rlike(r"^DECIMAL\(\d+,0\)$"), F.lit("bigint"))
        .when(seen.rlike("^(DECIMAL|DOUBLE|FLOAT)"), F.lit("double"))
        .when(seen == "VOID", F.lit(VOID))
        .otherwise(F.lit("string"))
    )
    return found.select("cdc_table", "name", kind.alias("type"))


def merged_types(types: DataFrame) -> DataFrame:
    """One type per table and member over many batches: that of all batches read as one.

    Whole and other numbers are numbers, any other disagreement is text, and so is a
    member that was null in every batch.
    """
    each = types.groupBy("cdc_table", "name").agg(F.array_sort(F.array_except(F.collect_set("type"), F.array(F.lit(VOID)))).alias("_all"))
    one = F.when(F.size("_all") == 1, F.get("_all", F.lit(0))).when(F.col("_all") == F.array(*map(F.lit, NUMBERS)), F.lit("double"))
    return each.select("cdc_table", "name", F.coalesce(one, F.lit("string")).alias("type"))


def typed_by(rows: DataFrame, types: DataFrame) -> DataFrame:
    """Rows of one unregistered table (``row`` a VARIANT) with the columns that ``types`` of many batches give it.

    Only names and merged types come to the driver; more than ``MOST_COLUMNS`` are refused.
    """
    merged = merged_types(types).limit(MOST_COLUMNS + 1).collect()
    if len(merged) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} member names: keep these rows as text maps")
    fields = [T.StructField(r["name"], T.DataType.fromDDL(r["type"])) for r in sorted(merged, key=lambda r: r["name"])]
    return _typed_members(rows, T.StructType(fields))
