"""Named queries over the standard tables, each with the rows of the inventory it answers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    rows: tuple[int, ...]
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(name: str, *rows: int, sql: str | None = None) -> Callable[[Run], Run]:
    """Registers a query; ``sql`` states the same result for an independent engine."""

    def register(run: Run) -> Run:
        if name in CATALOGUE:
            raise ValueError(f"query registered twice: {name}")
        CATALOGUE[name] = Query(name, run, rows, sql)
        return run

    return register
