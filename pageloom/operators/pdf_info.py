"""PDF base information as a table ``(source, version, info, metadata, num_pages)``.

One row per file that could be read; a file without a row could not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.columns import is_open
from pageloom.functions.metadata import caller_keys
from pageloom.schemas import OPEN_PDF, PDF


def doc_info(pdf_info: DataFrame) -> DataFrame:
    """Complete the table: absent info or metadata columns become NULL.

    Both are maps of strings, or of typed values where the table has such (a
    map, a struct or a VARIANT object).
    """
    return pdf_info.select(
        "source",
        F.col("version").cast("string").alias("version"),
        caller_keys(pdf_info, "info"),
        caller_keys(pdf_info, "metadata"),
        F.col("num_pages").cast("int").alias("num_pages"),
    )


def one_per_source(info: DataFrame) -> DataFrame:
    """Of several info rows of a file the one with most pages, then by version and contents.

    Runs that append leave such rows. Only this short table is grouped.
    """
    rank = F.struct(
        F.coalesce("num_pages", F.lit(-1)),
        F.coalesce("version", F.lit("")),
        F.coalesce(F.to_json("info"), F.lit("")),
        F.coalesce(F.to_json("metadata"), F.lit("")),
    )
    best = info.groupBy("source").agg(F.max_by(F.struct(*info.columns), rank).alias("row"))
    return best.select("row.*")


def attach_pdf_info(files: DataFrame, pdf_info: DataFrame) -> DataFrame:
    """Set ``pdf`` of PDF rows from their info; unread files keep what they had.

    A left join with no hint: the info table grows with the files, so whether
    it may be broadcast is left to its measured size, and a hot source on the
    left is split by the adaptive skew join. Join names and short columns:
    before bytes are read, or answers joined, and never their rows.
    """
    info, kind = read_pdf(pdf_info, is_open(files, "pdf"))
    joined = files.join(info, "source", "left")
    is_read = (F.col("kind") == "pdf") & F.col("read_pdf").isNotNull()
    pdf = F.when(is_read, F.col("read_pdf")).otherwise(F.col("pdf").cast(kind))
    return joined.withColumn("pdf", pdf).drop("read_pdf")


def read_pdf(pdf_info: DataFrame, typed: bool = False) -> tuple[DataFrame, T.StructType]:
    """``(source, read_pdf)``, one row per source, and the type of what is read; ``typed`` asks for typed values."""
    info = one_per_source(doc_info(pdf_info))
    kind = OPEN_PDF if typed or is_open(info, "info") or is_open(info, "metadata") else PDF
    read = F.struct("version", "info", "metadata", F.col("num_pages").alias("totalPages"), F.lit(None).alias("loc"))
    return info.select("source", read.cast(kind).alias("read_pdf")), kind


def task_info(files: DataFrame, pdf_info: DataFrame, folder: str) -> T.StructType:
    """Write the info of the files' sources to a folder, by the number of the task that reads each file.

    Only names and info meet in a join and move: a file's row, with its bytes,
    stays where it is, and ``apply_ocr`` takes its info from the folder. Every
    source is there, with NULL if it was not read. Returned is the type of the info.
    """
    info, kind = read_pdf(pdf_info, is_open(files, "pdf"))
    names = files.select("source", F.spark_partition_id().alias("task")).where("source IS NOT NULL").distinct()
    keyed = names.join(info, "source", "left").select("task", "source", F.to_json("read_pdf").alias("read_pdf"))
    # A task's sources in one file.
    keyed.repartition("task").write.partitionBy("task").parquet(folder)
    return kind


def with_task_info(answers: DataFrame, kind: T.StructType) -> DataFrame:
    """``pdf`` of answered rows that came with ``read_pdf``."""
    read = F.from_json("read_pdf", kind)
    is_read = (F.col("kind") == "pdf") & read.isNotNull()
    return answers.withColumn("pdf", F.when(is_read, read).otherwise(F.col("pdf").cast(kind))).drop("read_pdf")
