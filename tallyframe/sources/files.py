"""Delimited text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.columns import normalize_column_names


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",",
    encoding: str = "UTF-8", header: bool = True, normalize: bool = False,
) -> DataFrame:
    """Read delimited text. With a declared schema the file is read once; without one
    Spark reads it a first time to infer the types."""
    reader = spark.read.options(sep=sep, encoding=encoding, header=header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return normalize_column_names(df) if normalize else df


def scan_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, into: str, sep: str = ",", encoding: str = "UTF-8", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows of delimited text that fit the declared schema, and those that do not.

    The text is read once: all lines go to the folder ``into``, fitting ones and others apart, and both tables are read from there. A
    rejected row has file, line and reason: ``columns`` if it has more or fewer than the schema, else the first column whose value
    does not fit. Both together are all lines but headers and empty ones.
    """
    line = "__line"
    reader = spark.read.options(sep=sep, encoding=encoding, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=line)
    rows = reader.schema(T.StructType([*schema.fields, T.StructField(line, T.StringType())])).csv(path)
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema.fields) + 1)])
    parts = F.from_csv(F.col(line), texts.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"sep": sep})
    # A line with too few columns lacks the last one, a line with too many has one beyond.
    cut = F.size(F.split(F.col(line), f"\\Q{sep}\\E", -1))
    misfit = [F.when(parts[f"c{i}"].isNotNull() & parts[f"c{i}"].try_cast(f.dataType).isNull(), F.lit(f.name)) for i, f in enumerate(schema.fields)]
    count = F.when((cut < len(schema.fields)) | parts[f"c{len(schema.fields)}"].isNotNull(), F.lit("columns"))
    reason = F.when(F.col(line).isNotNull(), F.coalesce(count, *misfit, F.lit("unreadable")))
    checked = rows.select("*", F.col("_metadata.file_path").alias("__file"), reason.alias("__reason"), F.col(line).isNull().alias("__fits"))
    checked.write.partitionBy("__fits").parquet(into)
    stored = spark.read.schema(checked.schema).parquet(into)
    good = stored.filter("__fits").select(*[F.col(f"`{f.name}`") for f in schema.fields])
    return good, stored.filter("NOT __fits").select(F.col("__file").alias("file"), F.col(line).alias("line"), F.col("__reason").alias("reason"))
