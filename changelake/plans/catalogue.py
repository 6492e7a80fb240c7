"""The named queries: how Spark answers each, and the SQL that checks it.

Each entry takes ``(spark, sf_dir)`` and reads the given tables there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    run: Query
    oracle: str | None


class Catalogue:
    """Registry filled by the query modules."""

    def __init__(self) -> None:
        self.entries: dict[str, Entry] = {}

    def add(self, name: str, run: Query, oracle: str | None = None) -> None:
        if name in self.entries:
            raise ValueError(f"query {name} is registered twice")
        self.entries[name] = Entry(name, run, oracle)

    def query(self, oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        """Decorator form of ``add``; the function name is the query name."""

        def register(run: Query) -> Query:
            self.add(name or run.__name__, run, oracle)
            return run

        return register

    def queries(self) -> dict[str, Query]:
        return {n: e.run for n, e in self.entries.items()}

    def oracles(self) -> dict[str, str]:
        return {n: e.oracle for n, e in self.entries.items() if e.oracle is not None}


def load() -> Catalogue:
    """The catalogue with every query module registered."""
    from changelake.plans import (
        envelope_queries,
        hybrid_queries,
        lake_queries,
        log_queries,
        order_entry_queries,
        upkeep_queries,
    )

    catalogue = Catalogue()
    for module in (log_queries, hybrid_queries, order_entry_queries, envelope_queries, lake_queries, upkeep_queries):
        module.register(catalogue)
    return catalogue
