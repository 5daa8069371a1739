"""Names of queries, their functions and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm.base import for_long_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register ``fn(spark, folder)`` under its own name. It runs with batch sizes for long texts."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            for_long_texts(spark)
            return fn(spark, folder)

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return run

    return register
