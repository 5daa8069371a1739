"""Whole tables and queries over them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def scan_parquet(spark: SparkSession, path: str, lower_names: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    return df.toDF(*[c.lower() for c in df.columns]) if lower_names else df


class Tables:
    """The Parquet tables of one folder, each read on first use: ``tables.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return scan_parquet(self.spark, f"{self.folder}/{name}.parquet")


def scan_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run a SELECT whose ``{name}`` placeholders stand for the given tables."""
    return spark.sql(sql, **tables)


def scan_subquery(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """The same, as a derived table that further operators can filter and project."""
    return spark.sql(f"SELECT * FROM ({sql}) AS subquery", **tables)


@dataclass(frozen=True)
class SplitColumn:
    """How to read a JDBC table in parallel: a numeric or date column and its bounds."""

    column: str
    lower: str
    upper: str
    parts: int


def jdbc_options(
    table: str | None = None, query: str | None = None, split: SplitColumn | None = None,
    fetch_size: int = 10000,
) -> dict[str, str]:
    """Reader options for a table or a query. A split query becomes a derived table,
    because Spark splits only tables."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"fetchsize": str(fetch_size)}
    if query is not None and split is None:
        options["query"] = query
    else:
        options["dbtable"] = table if table is not None else f"({query}) AS subquery"
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.parts),
        }
    return options


def scan_jdbc(
    spark: SparkSession, connection: Mapping[str, str], table: str | None = None,
    query: str | None = None, split: SplitColumn | None = None,
) -> DataFrame:
    """Read over JDBC. ``connection`` holds the caller's url, driver, user and password."""
    reader = spark.read.format("jdbc").options(**connection)
    return reader.options(**jdbc_options(table, query, split)).load()
