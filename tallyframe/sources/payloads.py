"""JSON payloads held in a text column."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.session import new_table_path


def infer_json_schema(df: DataFrame, json_col: str) -> str:
    """DDL type of a JSON text column, merged over all rows (one aggregate, one row back)."""
    return _inferred(df, F.try_parse_json(json_col))


def _inferred(df: DataFrame, tree: Column) -> str:
    row = df.select(F.schema_of_variant_agg(tree).alias("s")).first()
    text = row["s"] or "OBJECT<>"
    text = re.sub(r"\bOBJECT<", "STRUCT<", text)
    return re.sub(r"\bVOID\b", "STRING", text)


def json_column_infer(df: DataFrame, json_col: str, out: str = "doc") -> DataFrame:
    """Parse a JSON text column by its inferred schema; the other columns stay.

    The text is parsed once, to a variant that is written to the shared folder with the other columns: the schema is inferred
    from there, and values are taken from there by it.
    """
    path = new_table_path(df.sparkSession, "parsed")
    df.withColumn("__tree", F.try_parse_json(json_col)).write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    schema = _inferred(stored, F.col("__tree"))
    if schema == "STRUCT<>":  # no object anywhere, so there is nothing to take
        return stored.withColumn(out, F.from_json(json_col, schema)).drop("__tree")
    return stored.withColumn(out, F.try_variant_get("__tree", "$", schema)).drop("__tree")


def json_parse_schema(df: DataFrame, json_col: str, schema: T.StructType | str, out: str = "doc") -> DataFrame:
    """Parse a JSON text column by a declared schema."""
    return df.withColumn(out, F.from_json(json_col, schema))


def json_chain(df: DataFrame, json_col: str, steps: Sequence[tuple[str, str, str]]) -> DataFrame:
    """JSON text inside JSON text: each step is (new struct column, text it parses, DDL)."""
    parsed = df
    for out, source, ddl in steps:
        parsed = parsed.withColumn(out, F.from_json(F.col(source), ddl))
    return parsed


def json_envelope_records(
    df: DataFrame, json_col: str, path: Sequence[str], fields: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per record of the array at ``path``, all fields as text, missing ones null.

    ``fields`` maps output columns to field names; a dot reaches into a nested object.
    """
    tree: dict = {}
    for source in fields.values():
        here = tree
        *parents, leaf = source.split(".")
        for p in parents:
            here = here.setdefault(p, {})
        here[leaf] = None

    def struct_type(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(k, T.StringType() if v is None else struct_type(v)) for k, v in node.items()]
        )

    shape: T.DataType = T.ArrayType(struct_type(tree))
    for name in reversed(path):
        shape = T.StructType([T.StructField(name, shape)])
    records = F.from_json(json_col, shape)
    for name in path:
        records = records[name]
    rows = df.select(*keep, F.explode(records).alias("__r"))
    return rows.select(*keep, *[F.col(f"__r.{source}").alias(out) for out, source in fields.items()])
