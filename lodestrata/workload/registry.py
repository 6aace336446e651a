"""Named queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lodestrata.workload.lake import Lake, lake_for


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Callable[[Lake], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query over the lake; ``covers`` names the survey rows it exercises."""
    def add(run: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, covers, run, sql)
        return run

    return add


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(q: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: q.run(lake_for(spark, folder))

    return {name: bound(q) for name, q in QUERIES.items()}


def sql_queries() -> dict[str, str]:
    return {name: q.sql for name, q in QUERIES.items() if q.sql}
