"""Snapshot tables whose schema changes between days.

The schema of a table is stored beside its days. A day may bring new columns and wider types; the stored schema grows with it, and
every day is read by it: what an older day lacks is null, and what it holds in a narrower type is widened by the scan. A day
whose type is narrower or new for a column is written in the stored or wider type. A change that would lose values is refused
before anything is written.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.dates import day
from tallyframe.operators.columns import conform_to_schema

#: Types that may become a later one of the same row without loss.
WIDER = ([T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()], [T.FloatType(), T.DoubleType()], [T.DateType(), T.TimestampNTZType()])
#: Decimal digits that hold every value of an integer type.
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}


class SchemaChange(ValueError):
    """A change of schema that would lose values."""


def wider_type(column: str, old: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds values of both."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    for row in WIDER:
        if old in row and new in row:
            return max(old, new, key=row.index)
    if {type(old), type(new)} <= {T.ByteType, T.ShortType, T.IntegerType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        digits = max(old.precision - old.scale, new.precision - new.scale)
        if digits + scale > 38:
            raise SchemaChange(f"{column}: no decimal holds {old.simpleString()} and {new.simpleString()}")
        return T.DecimalType(digits + scale, scale)
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merged_schema(old, new, f"{column}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(wider_type(f"{column}[]", old.elementType, new.elementType))
    raise SchemaChange(f"{column}: {old.simpleString()} cannot become {new.simpleString()}")


def merged_schema(old: T.StructType, new: T.StructType, inside: str = "") -> T.StructType:
    """Columns of both, without regard to case, in the old order and then the new one; types as wide as both need."""
    later = {f.name.lower(): f for f in new.fields}
    fields = []
    for f in old.fields:
        other = later.pop(f.name.lower(), None)
        fields.append(T.StructField(f.name, f.dataType if other is None else wider_type(inside + f.name, f.dataType, other.dataType)))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new.fields if f.name.lower() in later])


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The table's schema as of its last load, null before the first one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_schema")
    if not folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder):
        return None
    row = spark.read.schema("number long, schema string").json(f"{path}/_schema").orderBy(F.desc("number")).first()
    return T.StructType.fromJson(json.loads(row["schema"]))


def _store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Schemas are added, one row each, and the last one counts: a load that fails leaves the earlier one readable."""
    folder = f"{path}/_schema"
    known = 0 if stored_schema(spark, path) is None else spark.read.schema("number long, schema string").json(folder).agg(F.max("number")).first()[0] + 1
    spark.createDataFrame([(known, schema.json())], "number long, schema string").coalesce(1).write.mode("append").json(folder)


def _nullable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    return T.ArrayType(_nullable(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


def append_evolving(df: DataFrame, path: str, as_of: date | str, partition: str = "as_of") -> DataFrame:
    """Add or replace the snapshot of one day, let the table's schema grow to hold it, and return the table."""
    spark = df.sparkSession
    rows = df.drop(partition)
    own = _nullable(rows.schema)
    before = stored_schema(spark, path)
    schema = own if before is None else merged_schema(before, own)
    if before != schema:
        _store_schema(spark, path, schema)
    conform_to_schema(rows, schema, safe=False).write.mode("overwrite").parquet(f"{path}/{partition}={day(as_of).isoformat()}")
    return read_evolving(spark, path, partition)


def read_evolving(spark: SparkSession, path: str, partition: str = "as_of") -> DataFrame:
    """All days by the stored schema, the partition's day last."""
    schema = stored_schema(spark, path)
    if schema is None:
        raise ValueError(f"there is no table at {path}")
    whole = T.StructType([*schema.fields, T.StructField(partition, T.DateType())])
    return spark.read.schema(whole).option("basePath", path).parquet(f"{path}/{partition}=*")
