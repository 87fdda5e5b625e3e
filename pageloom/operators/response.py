"""Service responses to documents.

Everything here is row-wise on the response: one parse, one generator, no
shuffle. The parsed pages sit in a projection right below the generator, which
keeps the optimizer from parsing again in a pushed-down filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.columns import column_or_null, held_column
from pageloom.functions.metadata import caller_keys, image_loc, merged_extra, pdf_loc
from pageloom.functions.regions import image_regions, page_dimensions
from pageloom.functions.text import page_text
from pageloom.operators.ocr import wrap_error
from pageloom.schemas import CHECKED_RESPONSE, LOC, OPEN_PDF, PDF, RESPONSE, RESPONSE_PAGE, TEXT_RESPONSE

# Messages.
MALFORMED_RESPONSE = "Malformed response structure"
NULL_PAGE = "Cannot read properties of null (reading 'images')"
NULL_REGION = "Cannot read properties of null (reading 'id')"

# Separator *between* the pages of a combined document.
PAGE_JOINT = "\n\n"


def parse_response(responses: DataFrame, schema: T.StructType = RESPONSE) -> DataFrame:
    """Add the typed ``pages`` of the answer; NULL when it has none.

    With a smaller ``schema`` the rest of the answer is skipped.
    """
    return responses.withColumn("pages", F.from_json("response", schema)["pages"])


def malformed_response(kind: Column, pages: Column) -> Column:
    """True where the answer lacks pages, or an image's lacks its first page."""
    return pages.isNull() | ((kind == "image") & F.get(pages, F.lit(0)).isNull())


def used_pages(kind: Column, pages: Column) -> Column:
    """All pages of a PDF's answer, only the first of an image's."""
    return F.when(kind == "image", F.slice(pages, 1, 1)).otherwise(pages)


def response_fault(kind: Column, pages: Column, error: Column) -> Column:
    """Why the answer gives no documents, or NULL."""
    used = used_pages(kind, pages)
    fault = (
        F.when(error.isNotNull(), error)
        .when(malformed_response(kind, pages), F.lit(MALFORMED_RESPONSE))
        .when(F.exists(used, lambda page: page.isNull()), F.lit(NULL_PAGE))
        .when(
            F.exists(used, lambda page: F.exists(page["images"], lambda image: image.isNull())),
            F.lit(NULL_REGION),
        )
    )
    return wrap_error(fault)


def combined_text(pages: Column) -> Column:
    """Page texts of one answer joined into one text, without a shuffle."""
    return F.array_join(F.transform(pages, lambda page: page_text(page["markdown"])), PAGE_JOINT)


def check_responses(responses: DataFrame, schema: T.StructType = RESPONSE) -> DataFrame:
    """``(source, kind, extra, loc, pdf, pages, fault)``: answers read and checked.

    ``fault`` says why a file gives no documents. Written as a table, this is
    what documents and rejects are taken from without parsing again. A table
    that has been through it passes as it is. ``schema`` may be one that reads
    less; the checks are the same.
    """
    if "fault" in responses.columns:
        return responses
    parsed = parse_response(responses, schema)
    kind = F.col("kind")
    return parsed.select(
        "source",
        "kind",
        caller_keys(parsed, "extra"),
        column_or_null(parsed, "loc", LOC),
        held_column(parsed, "pdf", PDF, OPEN_PDF),
        used_pages(kind, F.col("pages")).alias("pages"),
        F.coalesce(
            column_or_null(parsed, "refused", T.StringType()),
            response_fault(kind, F.col("pages"), column_or_null(parsed, "error", T.StringType())),
        ).alias("fault"),
    )


def explode_pages(responses: DataFrame) -> DataFrame:
    """One row per page with its number, counted from 1.

    Answers that fail a check and answers with an empty page list give none.
    """
    checked = check_responses(responses)
    sound = F.when(F.col("fault").isNull(), F.col("pages"))
    rows = checked.select("source", "kind", "extra", "loc", "pdf", F.posexplode(sound).alias("pos", "page"))
    return rows.withColumn("page_no", F.col("pos") + 1).drop("pos")


def first_page(responses: DataFrame) -> DataFrame:
    """The one page kept of an image's answer."""
    return explode_pages(responses.filter(F.col("kind") == "image"))


def response_rejects(responses: DataFrame) -> DataFrame:
    """``rejects(source, error)`` of the files that gave no documents.

    Files refused before the call keep the reason they were refused for.
    """
    if "fault" in responses.columns:
        return responses.filter(F.col("fault").isNotNull()).select("source", F.col("fault").alias("error"))
    # Not a filter: pushed down, it would parse the answers a second time.
    faults = F.when(F.col("fault").isNotNull(), F.array("fault"))
    return check_responses(responses, CHECKED_RESPONSE).select("source", F.explode(faults).alias("error"))


def page_documents(pages: DataFrame) -> DataFrame:
    """Exploded pages to documents ``(source, page_content, metadata)``."""
    is_pdf = F.col("kind") == "pdf"
    metadata = F.struct(
        F.col("source").alias("source"),
        image_regions("page.images").alias("images"),
        page_dimensions("page").alias("dimensions"),
        F.when(is_pdf, F.col("loc")).otherwise(image_loc("loc")).alias("loc"),
        F.when(is_pdf, pdf_loc("pdf", "page_no")).otherwise(F.col("pdf")).alias("pdf"),
        merged_extra("extra").alias("extra"),
    )
    return pages.select("source", page_text("page.markdown").alias("page_content"), metadata.alias("metadata"))


def combine_pages(responses: DataFrame) -> DataFrame:
    """One document per PDF answer: page texts joined, only the caller's metadata.

    An answer with an empty page list still gives one, empty document.
    """
    return _whole(check_responses(responses.filter(F.col("kind") == "pdf"), TEXT_RESPONSE), images=False)


def to_documents(responses: DataFrame, split_pages: bool = True) -> DataFrame:
    """Documents of all sound answers.

    ``split_pages`` only matters for PDFs; an image always gives one document
    with its regions. Without it each answer becomes one row through a
    one-element page list, so both kinds still share a single pass.
    """
    if split_pages:
        return page_documents(explode_pages(responses))

    return _whole(check_responses(responses))


def _whole(checked: DataFrame, images: bool = True) -> DataFrame:
    """One document per sound answer; without ``images`` all are of PDFs, of which only texts were read."""
    is_pdf = F.col("kind") == "pdf"
    joined = F.struct(
        combined_text(F.col("pages")).alias("markdown"),
        F.lit(None).alias("images"),
        F.lit(None).alias("dimensions"),
    ).cast(RESPONSE_PAGE)
    units = F.when(is_pdf, F.array(joined)).otherwise(F.col("pages")) if images else F.array(joined)
    rows = checked.select(
        "source",
        "kind",
        "extra",
        "loc",
        "pdf",
        F.explode(F.when(F.col("fault").isNull(), units)).alias("page"),
    )
    metadata = F.struct(
        F.col("source").alias("source"),
        F.when(~is_pdf, image_regions("page.images")).alias("images"),
        page_dimensions("page").alias("dimensions"),
        F.when(is_pdf, F.col("loc")).otherwise(image_loc("loc")).alias("loc"),
        F.col("pdf").alias("pdf"),
        F.when(is_pdf, F.col("extra")).otherwise(merged_extra("extra")).alias("extra"),
    )
    return rows.select("source", page_text("page.markdown").alias("page_content"), metadata.alias("metadata"))
