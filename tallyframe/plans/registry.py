"""The registry of queries: name, Spark function, expected SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyframe.sources.tables import Tables

# Run dates of the queries, inside the ranges of the provided tables.
ORDERS_AS_OF = "2000-06-30"
EVENTS_AS_OF = "2024-01-16"


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.run(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under its own name."""

    def register(fn: Callable[[Tables], DataFrame]):
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} is registered twice")
        QUERIES[fn.__name__] = Query(fn.__name__, fn, sql)
        return fn

    return register
