"""Loads into Parquet tables.

A snapshot table is partitioned by its date, and a load replaces its own day, with rows or without, so running a load
again gives the same table. Upserts go to a table partitioned by a value that follows from the key, such as a bucket of its
hash: only partitions that get rows are read and rewritten, from a table written on the way, so no path is overwritten
while it is read. Where a whole table is merged, the version of the run date is written and an earlier one read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.dates import day, yesterday
from tallyframe.operators.merges import hash_validity_merge, upsert_replace
from tallyframe.operators.quality import require_unique
from tallyframe.session import new_table_path
from tallyframe.sources.calendar import NON_BUSINESS_DAY


def _replace_partitions(df: DataFrame, path: str, partition: str) -> DataFrame:
    """Rebalanced by partition value: few files for a small day, many tasks for a large one."""
    writer = df.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_snapshot(df: DataFrame, path: str, as_of: date | str, partition: str = "as_of") -> DataFrame:
    """Add the snapshot of one day. Loading that day again replaces it, and loading it without rows empties it.

    While a day is replaced, a reader does not see it; other days stay as they are.
    """
    rows = df.drop(partition)
    rows.write.mode("overwrite").parquet(f"{path}/{partition}={day(as_of).isoformat()}")
    schema = T.StructType([*rows.schema.fields, T.StructField(partition, T.DateType())])
    return df.sparkSession.read.schema(schema).parquet(path)


def append_partitions(df: DataFrame, path: str, partition: str) -> DataFrame:
    """Replace the partitions that ``df`` has rows for; its partition column names them."""
    return _replace_partitions(df, path, partition)


def truncate_load(df: DataFrame, path: str) -> DataFrame:
    """Replace all rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame) -> DataFrame:
    """A small result, such as one row per year, written and read again: its size on disk decides how it is joined, so a fact
    table need not be shuffled on a handful of values."""
    return truncate_load(df, new_table_path(df.sparkSession, "measured"))


def recreate_load(
    df: DataFrame, path: str, key: Sequence[str] = (), sort: Sequence[str] = (), spread: Sequence[str] = ()
) -> DataFrame:
    """Replace rows and schema; check the declared key, spread and sort the files.

    Rows are rebalanced by the spread columns, so a hot value becomes several files.
    """
    if key:
        require_unique(df, key)
    if spread:
        df = df.hint("rebalance", *spread)
    if sort:
        df = df.sortWithinPartitions(*sort)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def bucketed_load(
    df: DataFrame, name: str, key: Sequence[str], buckets: int, path: str | None = None, unique: bool = False
) -> DataFrame:
    """Replace the catalog table ``name`` with rows bucketed and sorted by ``key``, and return it.

    Two tables bucketed alike by their join key are joined, and aggregated by it, without a shuffle. ``path`` is the table's
    folder (the warehouse's own if none is given); rows are dealt to buckets before they are written, so a bucket is one file.
    """
    if unique:
        require_unique(df, key)
    writer = df.repartition(buckets, *key).write.mode("overwrite").bucketBy(buckets, *key).sortBy(*key)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def buckets_for(rows: int, least: int, rows_each: int = 1_000_000) -> int:
    """A power-of-two multiple of ``least`` such that a bucket gets about ``rows_each`` rows at most."""
    buckets = least
    while buckets * rows_each < rows:
        buckets *= 2
    return buckets


def version_path(path: str, as_of: date | str) -> str:
    return f"{path}/version={day(as_of).isoformat()}"


def write_version(df: DataFrame, path: str, as_of: date | str) -> DataFrame:
    """Write a table as the version of its run date."""
    return truncate_load(df, version_path(path, as_of))


def read_version(spark: SparkSession, path: str, as_of: date | str) -> DataFrame:
    return spark.read.parquet(version_path(path, as_of))


def merge_version(
    staged: DataFrame, path: str, before: date | str, as_of: date | str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> DataFrame:
    """Merge into the version ``before`` and write the version ``as_of``."""
    if day(before) >= day(as_of):
        raise ValueError("a merge reads an earlier version than it writes")
    target = read_version(staged.sparkSession, path, before)
    return write_version(merge(target, staged), path, as_of)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row's key: the same for the same key in every load."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_touched(
    staged: DataFrame, path: str, partition: str, merge: Callable[[DataFrame, DataFrame], DataFrame]
) -> DataFrame:
    """``merge`` staged rows into those partitions of a table that they belong to; no other file is read or written.

    The partition value must follow from the key. The values found in ``staged``, at most one per partition, become
    literals, so the scan is pruned before it starts. The merged rows are written aside before they replace anything.
    """
    spark = staged.sparkSession
    target = spark.read.parquet(path)
    values = [r[0] for r in staged.select(partition).distinct().collect()]
    there = F.col(partition).isin([v for v in values if v is not None])
    if None in values:
        there = there | F.col(partition).isNull()
    merged = merge(target.filter(there), staged.select(target.columns)).select(target.columns)
    aside = truncate_load(merged, new_table_path(spark, "merged"))
    _replace_partitions(aside, path, partition)
    return spark.read.schema(target.schema).parquet(path)


def merge_partitions(staged: DataFrame, path: str, keys: Sequence[str], partition: str) -> DataFrame:
    """Upsert into a partitioned table, rewriting only the partitions that get rows."""
    return merge_touched(staged, path, partition, lambda old, new: upsert_replace(old, new, keys))


def rollforward_snapshot(
    spark: SparkSession, path: str, as_of: date | str, flag: str | None,
    load: Callable[[], DataFrame], date_col: str = "cut_date",
) -> DataFrame:
    """Add the snapshot of the day before the run. When that day was no business day the
    snapshot of the day before it is repeated, else ``load()`` provides the rows."""
    cut = yesterday(as_of)
    if flag == NON_BUSINESS_DAY:
        before = f"{path}/{date_col}={yesterday(cut).isoformat()}"
        rows = spark.read.parquet(before)
    else:
        rows = load()
    return append_snapshot(rows, path, cut, date_col)


def is_month_start(now: datetime, zone: str) -> bool:
    """Is it day 1 in the given time zone."""
    return now.astimezone(ZoneInfo(zone)).day == 1


def month_gated_copy(df: DataFrame, path: str, now: datetime, zone: str) -> DataFrame | None:
    """On day 1 add a copy of the table, stamped with the local date; else do nothing."""
    if not is_month_start(now, zone):
        return None
    return append_snapshot(df, path, now.astimezone(ZoneInfo(zone)).date())


def export_dated_csv(
    df: DataFrame, path: str, as_of: date | str, folder: str = "cut_date", single_file: bool = False
) -> str:
    """Headed CSV under ``folder=yyyymmdd``, replacing that day's files.

    ``single_file`` sends all rows through one task: only for small extracts.
    """
    target = f"{path}/{folder}={day(as_of):%Y%m%d}"
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(target)
    return target


def publish(df: DataFrame, path: str, as_of: date | str, partition: str = "as_of") -> DataFrame:
    """Load the snapshot of a day, export it as dated CSV beside it, and return the day's rows read back."""
    history = append_snapshot(df, f"{path}/table", as_of, partition)
    own = history.filter(F.col(partition) == F.lit(day(as_of))).drop(partition)
    export_dated_csv(own, f"{path}/csv", as_of)
    return own


def current_view(df: DataFrame, name: str, date_col: str | None = None, on: date | str | None = None) -> DataFrame:
    """Register a view of one day of a history table, or of the whole table."""
    view = df.filter(F.col(date_col) == F.lit(day(on))) if date_col else df
    view.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def append_validity(staged: DataFrame, path: str, as_of: date | str) -> None:
    """Add one delivery of a history by content: its own rows are written, nothing is read or rewritten.

    Running the delivery of a day again replaces that day's rows.
    """
    append_snapshot(staged, path, as_of, "delivered")


def read_validity(spark: SparkSession, path: str, content: Sequence[str], **columns: str) -> DataFrame:
    """The history: one row per content over all deliveries, by a map-side combined aggregate."""
    rows = spark.read.parquet(path).drop("delivered")
    return hash_validity_merge(rows.limit(0), rows, content, **columns)


def compact_validity(spark: SparkSession, path: str, content: Sequence[str], as_of: date | str, **columns: str) -> None:
    """Merge the deliveries up to a day into that day's, so that readers find each content of theirs once.

    The merged rows are written aside, then replace the day, and only then the earlier days are emptied. A history in which both
    are still there reads the same, so a run that stops half way does no harm and can be run again.
    """
    rows = spark.read.parquet(path).filter(F.col("delivered") <= F.lit(day(as_of))).drop("delivered")
    merged = truncate_load(hash_validity_merge(rows.limit(0), rows, content, **columns), new_table_path(spark, "validity"))
    append_snapshot(merged, path, as_of, "delivered")
    for earlier in partition_values(spark, path).get("delivered", []):
        if earlier < day(as_of).isoformat():
            append_snapshot(merged.limit(0), path, earlier, "delivered")


def partition_values(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Partition columns of a table's first level and their values, from the names of its folders: no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    out: dict[str, list[str]] = {}
    for status in system.listStatus(folder):
        column, _, value = status.getPath().getName().partition("=")
        if status.isDirectory() and value and system.listStatus(status.getPath()):
            out.setdefault(column, []).append(value)
    return out


def last_day(spark: SparkSession, path: str, partition: str = "as_of") -> date:
    """The newest day of a snapshot table, from the names of its partitions."""
    days = [d for d in partition_values(spark, path).get(partition, []) if d != "__HIVE_DEFAULT_PARTITION__"]
    if not days:
        raise ValueError(f"the table at {path} has no {partition}")
    return date.fromisoformat(max(days))


def latest_view(spark: SparkSession, path: str, name: str | None = None, schema: T.StructType | None = None, partition: str = "as_of") -> DataFrame:
    """The newest day of a snapshot table, as a view if it gets a name. Files of other days are not read, not even for the schema."""
    found = last_day(spark, path, partition).isoformat()
    reader = spark.read.option("basePath", path)
    view = (reader.schema(schema) if schema else reader).parquet(f"{path}/{partition}={found}")
    if name:
        view.createOrReplaceTempView(name)
    return view
