"""Projection and column naming. Names are worked out on the driver, data in one select."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.text import fold_name


def project_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the given columns under new names, in the given order."""
    return df.select([F.col(old).alias(new) for old, new in names.items()])


def constant_columns(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """All columns plus literal ones."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in values.items()])


def normalized_name(name: str, upper: bool = True, drop: str = "") -> str:
    text = "".join(ch for ch in fold_name(name) if ch not in drop)
    text = "_".join(text.split())
    return text.upper() if upper else text


def normalize_column_names(df: DataFrame, upper: bool = True, drop: str = "") -> DataFrame:
    """No accents, no outer blanks, inner blanks as ``_``, one letter case."""
    names = [normalized_name(c, upper, drop) for c in df.columns]
    twice = {n for n in names if names.count(n) > 1}
    if twice:
        raise ValueError(f"column names collide after normalising: {sorted(twice)}")
    return df.toDF(*names)


def rename_by_pattern(df: DataFrame, words_to_name: Mapping[tuple[str, ...], str]) -> DataFrame:
    """Rename the first column whose folded name contains all the given words."""
    renames = {}
    for words, new in words_to_name.items():
        wanted = [fold_name(w) for w in words]
        hit = next((c for c in df.columns if all(w in fold_name(c) for w in wanted)), None)
        if hit is not None:
            renames[hit] = new
    return df.withColumnsRenamed(renames)


def schema_path_find(schema: T.StructType, name: str) -> str | None:
    """Dotted path of the first field with that folded name, outer levels first."""
    wanted = fold_name(name)
    level: list[tuple[str, T.DataType]] = [("", schema)]
    while level:
        below = []
        for prefix, dtype in level:
            if isinstance(dtype, T.StructType):
                for f in dtype.fields:
                    path = f"{prefix}.`{f.name}`" if prefix else f"`{f.name}`"
                    if fold_name(f.name) == wanted:
                        return path
                    below.append((path, f.dataType))
        level = below
    return None


def strip_prefix(name: str, prefixes: Sequence[str]) -> str:
    """The name without the first prefix that fits."""
    return next((name[len(p):] for p in prefixes if name.startswith(p)), name)


def resolve_column(
    df: DataFrame, name: str, root: str | None = None, prefixes: Sequence[str] = ()
) -> Column | None:
    """The column a wanted name stands for: under ``root``, by exact name, by folded name
    at any depth, then the same without its prefix. None when nothing fits."""
    bare = strip_prefix(name, prefixes)
    if root and root in df.columns:
        inner = df.schema[root].dataType
        for n in (name, bare):
            if isinstance(inner, T.StructType) and n in inner.names:
                return F.col(f"`{root}`.`{n}`")
    for n in (name, bare):
        if n in df.columns:
            return F.col(f"`{n}`")
        path = schema_path_find(df.schema, n)
        if path is not None:
            return F.col(path)
    return None


def select_available(
    df: DataFrame,
    wanted: Sequence[str],
    keep: Sequence[str] = (),
    root: str | None = None,
    prefixes: Sequence[str] = (),
    fallback: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One select of all wanted columns; a missing one is its fallback, else null text."""
    fallback = fallback or {}
    out = [F.col(f"`{k}`") for k in keep]
    for name in wanted:
        c = resolve_column(df, name, root, prefixes)
        if c is None:
            c = fallback.get(name, F.lit(None).cast("string"))
        out.append(c.alias(name))
    return df.select(out)


def ensure_columns(df: DataFrame, wanted: Sequence[str], default: object = "") -> DataFrame:
    """Exactly the wanted columns in order; missing ones hold ``default``."""
    return df.select(
        [F.col(f"`{c}`") if c in df.columns else F.lit(default).alias(c) for c in wanted]
    )


def null_to_blank_all(df: DataFrame) -> DataFrame:
    """Every column as text, null as the empty text."""
    return cast_all_string(df).fillna("")


def cast_all_string(df: DataFrame) -> DataFrame:
    return df.select(
        [
            F.col(f"`{f.name}`") if f.dataType == T.StringType() else F.col(f"`{f.name}`").cast("string").alias(f.name)
            for f in df.schema.fields
        ]
    )


def truncate_strings(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Cut the named text columns to their target length; the others stay whole."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in lengths and isinstance(f.dataType, T.StringType):
            c = F.substring(c, 1, lengths[f.name]).alias(f.name)
        out.append(c)
    return df.select(out)


def map_text_columns(df: DataFrame, fn) -> DataFrame:
    """Apply a column function to every text column, in one select."""
    return df.select(
        [
            fn(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def conform_to_schema(df: DataFrame, schema: T.StructType, safe: bool = True) -> DataFrame:
    """Cast to a declared target: its columns, order and types; missing columns are null.

    With ``safe`` a value that does not fit its type becomes null instead of an error.
    """
    have = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        source = have.get(f.name.lower())
        if source is None:
            c = F.lit(None).cast(f.dataType)
        else:
            c = F.col(f"`{source}`")
            c = c.try_cast(f.dataType) if safe else c.cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(out)


def empty_like(spark, schema: T.StructType) -> DataFrame:
    """No rows, the given schema: enough to create a target table."""
    return spark.createDataFrame([], schema)


def clean_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows in which all the given columns are null."""
    return df.dropna("all", subset=list(subset))
