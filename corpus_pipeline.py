"""Documents -> packed training sequences, in stages that are written and reread.

Every stage but the last returns the columns of its input.  Rows that repeat a doc_id
with different texts are different documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import linededup, mixing, nearcopies, packing, simhash, toxicity
from tabulon.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, unchanged; null texts are scored as empty ones."""
    return toxicity.not_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without line chunks that stand elsewhere; n_chars follows the text.

    Null texts stay null; rows that repeat id and text fare alike; a text whose lines all stand elsewhere becomes empty.
    """
    cleaned = linededup.dedup_lines(docs, counts=False)
    if "n_chars" in cleaned.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return cleaned.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash component (the operator of op2); of these, none that an exact check finds a near copy (five-word Jaccard of 0.8 or more) of a smaller id."""
    first = stored(simhash.one_of_each(docs), "pipeline-simhash", lasting=True)
    return nearcopies.without_near_copies(first)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, which may be not at all or twice."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences."""
    return packing.packed(docs).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The toxicity model, the line chunks and the shingle sets have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
