"""From documents to packed training sequences: quality, near copies, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import quality, similar, suffixes
from pageloom.llm.common import materialize
from pageloom.llm.queries import LEAST_QUALITY, packed, quality_model, table
from pageloom.session import release, run_dir, scratch

#: What the classifier rejects and which copy stays can't be said in SQL.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=("lang", "source", "n_chars"))
    return scored.where(F.col("score") >= LEAST_QUALITY).select("doc_id", "text", "lang", "source", "n_chars")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group linked by five-word shingles at a Jaccard coefficient of 0.8."""
    return similar.keep_one(docs, words=5, percent=80).select("doc_id", "text", "lang", "source", "n_chars")


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without 400-byte strings that occur more than once.

    All occurrences go. What is left of a character that was cut goes as well;
    a document of which nothing is left stays, with an empty text.
    """
    cut = suffixes.remove_repeats(docs, length=400, keep=("lang", "source"))
    n_chars = F.char_length("kept_text").cast("long").alias("n_chars")
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", n_chars)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 4096 tokens."""
    return packed(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_near_copies),
    ("suffix-array dedup", without_repeated_passages),
    ("best-fit packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the documents that all stages keep.

    A stage's own tables are deleted when its result is written, and that
    result when the next one is. Null and empty texts, rows without a doc_id
    and repeated rows are judged by each stage as its operator says; an empty
    table gives an empty table.
    """
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        folder = run_dir(spark, name.replace(" ", "-"))
        with scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), "documents", folder)
        if read:
            release(spark, read)
        read = folder
    return STAGES[-1][1](spark, docs, sf_dir)
