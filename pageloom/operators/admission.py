"""Which files enter, and as what.

Checks run in a fixed order (source, then extension) and are all row-wise, so
a bad file costs one row in ``rejects`` and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.columns import column_or_null, held_column, is_open
from pageloom.functions.metadata import COLUMN_KEYS, caller_keys, caller_loc, caller_pdf, without_keys
from pageloom.functions.paths import file_ext
from pageloom.options import LoadOptions
from pageloom.schemas import FILES, LOC, OPEN_MAP, OPEN_PDF, PDF, STRING_MAP

# Messages.
SOURCE_REQUIRED = "File path is required in metadata.source"
UNSUPPORTED_TYPE = "Unsupported file type. Supported types: "
FILE_NOT_FOUND = "File not found: "
NO_PATH = "undefined"


def ingest_table(df: DataFrame) -> DataFrame:
    """Bytes already held in a table, with whatever metadata the caller has.

    Needs ``source`` and ``content``; ``extra``, ``loc``, ``pdf`` and ``error``
    (why the bytes could not be read) are optional. ``loc`` and ``pdf`` may
    also sit in ``extra``, as objects or as JSON text.

    ``extra`` is a map of strings, or holds typed values: a map of others, a
    struct or a VARIANT object. Typed values stay typed in all that follows
    (see ``caller_keys``), and so do those of ``pdf``.
    """
    df = df.select(
        F.col("source").cast("string"),
        F.col("content"),
        caller_keys(df, "extra"),
        held_column(df, "pdf", PDF, OPEN_PDF),
        *[column_or_null(df, name, FILES[name].dataType) for name in ("loc", "error")],
    )
    typed = is_open(df, "extra")
    pdf_kind = OPEN_PDF if typed or is_open(df, "pdf") else PDF
    return df.select(
        "source",
        "content",
        without_keys("extra", COLUMN_KEYS).cast(OPEN_MAP if typed else STRING_MAP).alias("extra"),
        caller_loc(F.col("loc"), F.col("extra"), typed).cast(LOC).alias("loc"),
        F.coalesce(F.col("pdf").cast(pdf_kind), caller_pdf(F.lit(None), F.col("extra"), typed).cast(pdf_kind)).alias("pdf"),
        "error",
    )


def source_error(source: Column) -> Column:
    return F.when(source.isNull() | (source == ""), F.lit(SOURCE_REQUIRED))


def type_error(ext: Column, types: tuple[str, ...]) -> Column:
    # Only the file's extension is lower-cased: an upper-case entry of the
    # list matches nothing.
    return F.when(~ext.isin(*types), F.lit(UNSUPPORTED_TYPE + ", ".join(types)))


def route_kind(ext: Column, types: tuple[str, ...]) -> Column:
    """``pdf`` for ``.pdf``, ``image`` for every other admitted extension."""
    return F.when(ext.isin(*types), F.when(ext == ".pdf", "pdf").otherwise("image"))


def admit(files: DataFrame, options: LoadOptions = LoadOptions()) -> DataFrame:
    """Add ``ext``, ``kind`` and ``error`` (NULL for admitted files).

    An error the files come with stands before those found here.
    """
    types = options.types
    ext = F.col("ext")
    checks = [source_error(F.col("source")), type_error(ext, types)]
    if "error" in files.columns:
        checks.insert(0, F.col("error"))
    return (
        files.withColumn("ext", file_ext("source"))
        .withColumn("kind", route_kind(ext, types))
        .withColumn("error", F.coalesce(*checks))
    )


def accepted(admitted: DataFrame) -> DataFrame:
    return admitted.filter(F.col("error").isNull()).drop("error")


def rejected(admitted: DataFrame) -> DataFrame:
    """``rejects(source, error)``; file bytes are not read for it."""
    return admitted.filter(F.col("error").isNotNull()).select("source", "error")


def missing_sources(requested: DataFrame, scanned: DataFrame) -> DataFrame:
    """``(source, error, requests)`` of requested paths no scan found.

    One reject per path with the number of requests for it. Both sides collapse
    to one row per path before their shuffle, so no path is hot in the join,
    which then needs no shuffle of its own.
    """
    asked = requested.groupBy("source").agg(F.count(F.lit(1)).alias("requests"))
    found = scanned.select("source").distinct()
    error = F.concat(F.lit(FILE_NOT_FOUND), F.coalesce("source", F.lit(NO_PATH)))
    return asked.join(found, "source", "left_anti").select("source", error.alias("error"), "requests")


def fail_on_error(df: DataFrame, error: str = "error") -> DataFrame:
    """Strict mode: raise the message of the first bad row the job meets.

    The check is a filter, so it survives column pruning.
    """
    ok = F.when(F.col(error).isNotNull(), F.raise_error(F.col(error)).cast("boolean")).otherwise(True)
    return df.filter(ok)
