"""The corpus pipeline: from ``documents`` to token ids, in stages that each write a table.

    from corpus_pipeline import run
    tokens = run(spark, "/data/corpus")

Each stage takes (spark, docs, folder of tables) and returns a DataFrame; all but the last keep the columns of
``documents``. A stage's result is written as Parquet to the shared folder and read again as the next one's input,
so a lost executor costs tasks of one stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import bpe, mixing, setjoin, suffixes, toxicity
from tallyframe.llm.base import for_long_texts, settle, table
from tallyframe.llm.queries import MODEL


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(fn: Stage) -> Stage:
    """A stage runs with batch sizes for long texts, whoever calls it."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        for_long_texts(spark)
        return fn(spark, docs, folder)

    return run_stage


@_stage
def toxic_out(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents scored below 0.5 stay. The model is learned from labelled rows of ``docs``, held-out ones aside."""
    weights = toxicity.model(docs, table(spark, folder, "labels"))
    return toxicity.scored(docs, weights, name="__score").filter("__score < 0.5").drop("__score")


@_stage
def near_copies_out(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents linked by sets of five-word shingles with a similarity of 0.8 or more, the one with the smallest id stays."""
    return setjoin.one_of_each(docs)


#: Repeated strings of so many bytes go: 51 words reach it unless they are shorter than 3.7 letters on average. The operator's
#: other two lengths are in proportion.
REPEAT_BYTES, REPEAT_GRAM, REPEAT_REACH = 240, 20, 110


@_stage
def repeats_out(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Strings of 240 bytes that start more than once go from every text; documents stay, if need be empty."""
    return suffixes.without_repeats(docs, REPEAT_BYTES, REPEAT_GRAM, REPEAT_REACH)


@_stage
def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as the mix of sources uses it: not at all, once, twice or three times."""
    packed = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("row"))
    rows, _ = mixing.mix_documents(packed)
    uses = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return rows.filter("times > 0").select("row", uses).select("row.*")


@_stage
def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, ids, n_tokens and lossless (the decoded ids are the text), one row per row of ``docs``."""
    return bpe.encoded(docs, MODEL, check=True)


STAGES = [
    ("toxicity", toxic_out),
    ("n-gram Jaccard join", near_copies_out),
    ("suffix-array dedup", repeats_out),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", tokens),
]

#: None of learning, links, suffixes, seeded mixing and merges can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = settle(stage(spark, docs, sf_dir), f"stage_{number}")
    return docs
