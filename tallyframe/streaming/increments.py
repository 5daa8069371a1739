"""Daily increments as a stream that reads each new file once and then stops."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_increments(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def once_each(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Each event once, however many files bring it: the first one that comes stays.

    Keys that were seen are state, kept until the watermark (the newest ``time`` less ``delay``) has passed them, so the state is bounded by
    the events of ``delay`` and not by the table. ``delay`` must be at least as long as repeats and late events take: an event older
    than the watermark is not counted. Of a table that is no stream, one row per key stays.
    """
    if not stream.isStreaming:
        return stream.dropDuplicates(list(keys))
    # A watermark wants an instant; a local time column stays as it is beside it.
    timed = stream.withColumn("__at", F.col(time).cast("timestamp")).withWatermark("__at", delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("__at")


def append_increments(
    stream: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """Append everything new to a table, each input file exactly once, and return it.

    The file sink's own log makes a repeated batch harmless.
    """
    out = transform(stream)
    query = (
        out.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return out.sparkSession.read.schema(out.schema).parquet(path)


def load_increments(
    stream: DataFrame, checkpoint: str, load: Callable[[DataFrame, int], object]
) -> None:
    """Hand each micro-batch, empty ones too, to a batch load. A batch may come twice after
    a failure, so ``load`` must give the same table when run again with the same number."""
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
