"""Questions asked of one row image held as a VARIANT column."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from changelake.schemas import DETECTION_RULES, OPERATION_CODES, UNKNOWN


def field(v: Column, name: str, data_type: str = "variant") -> Column:
    """Member of an object; SQL NULL when absent or not castable."""
    return F.try_variant_get(v, f"$.{name}", data_type)


def present(v: Column, name: str) -> Column:
    """True when the member exists, a JSON null included."""
    return field(v, name).isNotNull()


def members(v: Column) -> Column:
    """The object as a map, NULL for anything that is not an object."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def is_object(v: Column) -> Column:
    return members(v).isNotNull()


def is_truthy(v: Column) -> Column:
    """An object with at least one member."""
    return F.coalesce(F.size(members(v)) > 0, F.lit(False))


def is_json_null(v: Column) -> Column:
    return F.coalesce(F.is_variant_null(v), F.lit(False))


def _first(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """One flat CASE over the cases in order."""
    out = F.when(*cases[0])
    for condition, value in cases[1:]:
        out = out.when(condition, value)
    return out.otherwise(otherwise)


def members_of(v: Column, names: Iterable[str]) -> Column:
    """The named members of an object, each a VARIANT field of one struct, looked up in one pass."""
    return F.try_variant_get(v, "$", f"struct<{','.join(f'`{n}`:variant' for n in names)}>")


# The members that tell tables apart.
IDENTIFYING = tuple(dict.fromkeys(n for _, needed in DETECTION_RULES for n in needed))


def table_of(held: Column) -> Column:
    """Table by the identifying members in ``held``, first match wins; keep ``held`` in a column, it is used often."""
    cases = [(reduce(and_, [held[n].isNotNull() for n in needed]), F.lit(table)) for table, needed in DETECTION_RULES]
    return _first(cases, F.lit(UNKNOWN))


def detect_table(v: Column) -> Column:
    """Table whose identifying columns a row image carries, first match wins."""
    return table_of(members_of(v, IDENTIFYING))


def operation_name(code: Column) -> Column:
    """One-letter change code to its operation name."""
    return _first([(code == short, F.lit(name)) for short, name in OPERATION_CODES.items()], F.lit(UNKNOWN))
