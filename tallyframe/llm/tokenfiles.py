"""Token counts of documents in flat, unindexed token files, by a scan for separators.

A file holds 2-byte little-endian ids and nothing else; an end-of-document id closes each document. Files are cut into
blocks. A vectorised search finds the separators of each block, and documents inside one block are counted
there. Documents that cross blocks are stitched from one small row per block by a prefix scan: a running sum gives the
block's place in its file, a running maximum the last separator before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.llm.bpe import read_model

#: Bytes of an id, of a block, and the id that ends a document in files written here.
ID_BYTES = 2
BLOCK_BYTES = 1 << 20
END = 2


def write_token_files(docs: DataFrame, path: str, model_path: str, end: int = END, text_col: str = "text") -> None:
    """Encode every whole text of ``docs`` and write flat files, one per task, in the order of the rows.

    The text sink writes bytes as they are and puts its line separator after each row: here the bytes of the
    end-of-document id. An empty or null text is a document of no tokens.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    mark = end.to_bytes(ID_BYTES, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        lib = SentencePieceProcessor(model_proto=shared.value)
        if lib.get_piece_size() > 1 << 8 * ID_BYTES or not (lib.is_control(end) or lib.is_unused(end)):
            raise ValueError("ids must fit the files, and the end-of-document id must not come out of a text")
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                texts = [t or "" for t in batch.column(0).slice(at, 512).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([np.array(x, "<u2").tobytes() for x in lib.encode(texts, num_threads=1)], pa.binary())], ["ids"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "ids binary")
    rows.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", mark.decode()).text(path)


def blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, block, bytes) of all files under a path. A file is one row of the reader, so it may have up to 2 GB.

    Empty files have no blocks, hidden ones are skipped.
    """
    if block_bytes % ID_BYTES:
        raise ValueError("a block holds whole ids")
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select(F.col("path").alias("file"), "length", "content")
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / block_bytes)))
    cut = files.select("file", "content", number.alias("block"))
    return cut.select("file", "block", F.substring("content", (F.col("block") * block_bytes + 1).cast("int"), F.lit(block_bytes)).alias("bytes"))


def _search(end: int):
    """Of each block: its tokens, its separators, the first and last of them, and the documents between them."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data in batch.column(2).to_pylist():
                if len(data) % ID_BYTES:
                    raise ValueError("a file ends inside an id")
                found = np.flatnonzero(np.frombuffer(data, "<u2") == end)
                ends = (int(found[0]), int(found[-1])) if len(found) else (None, None)
                rows.append((len(data) // ID_BYTES, len(found), *ends, found))
            n, seps, first, last, found = zip(*rows) if rows else ((),) * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            columns = [pa.array(c, t) for c, t in zip((n, seps, first, last, found), types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["file", "block", "n", "ends", "first", "last", "found"])

    return search


def token_counts(parts: DataFrame, end: int = END) -> DataFrame:
    """One row per document of ``blocks``: file, doc_no (from 0 in its file), start (its first token's place), n_tokens, closed.

    Two separators in a row hold a document of no tokens. Tokens after the last separator are a document that is not closed;
    a file that ends with a separator has none.
    """
    found = parts.mapInArrow(_search(end), "file string, block long, n long, ends long, first long, last long, found array<long>")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    place = found.withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("doc_no", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    place = place.withColumn("open", F.coalesce(F.max(F.col("at") + F.col("last")).over(before), F.lit(-1)) + 1)
    place = place.withColumn("final", F.lead("block").over(order).isNull())
    closed = place.select("file", "doc_no", "at", "open", "found", F.posexplode("found").alias("nth", "sep"))
    start = F.when(F.col("nth") == 0, F.col("open")).otherwise(F.col("at") + F.col("found")[F.col("nth") - 1] + 1)
    closed = closed.select("file", (F.col("doc_no") + F.col("nth")).alias("doc_no"), start.alias("start"), (F.col("at") + F.col("sep") - start).alias("n_tokens"), F.lit(True).alias("closed"))
    begin = F.when(F.col("ends") > 0, F.col("at") + F.col("last") + 1).otherwise(F.col("open"))
    rest = place.filter("final").select("file", (F.col("doc_no") + F.col("ends")).alias("doc_no"), begin.alias("start"), (F.col("at") + F.col("n") - begin).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(rest.filter("n_tokens > 0"))
