"""Operators whose size is known from the query itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top_k(df: DataFrame, k: int | None, *order: Column) -> DataFrame:
    """First ``k`` rows of an order (all of them, sorted, for ``None``).

    Catalyst derives the bytes of a limit from its rows, so a join with a small top-k
    is broadcast by the session's own threshold and needs no hint.
    """
    out = df.orderBy(*order)
    return out if k is None else out.limit(k)
