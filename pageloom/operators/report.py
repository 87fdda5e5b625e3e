"""Readable summaries of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.columns import is_open
from pageloom.functions.json_text import metadata_json
from pageloom.functions.text import preview_fixed
from pageloom.operators.response import check_responses
from pageloom.schemas import CHECKED_RESPONSE


def page_report(documents: DataFrame) -> DataFrame:
    """``(source, page, preview, metadata)``: the page's start and its metadata.

    Typed keys are printed as what they are, nested ones indented like the rest.
    The page number is the document's place among those of its file.
    """
    meta = F.col("metadata")
    kinds = documents.select("metadata.extra", "metadata.pdf")
    page = F.when(meta["images"].isNotNull(), meta["pdf"]["loc"]["pageNumber"])
    return documents.select(
        "source",
        F.coalesce(page, F.lit(1)).alias("page"),
        preview_fixed("page_content").alias("preview"),
        metadata_json(meta, is_open(kinds, "extra"), is_open(kinds, "pdf")).alias("metadata"),
    )


def page_total(responses: DataFrame) -> DataFrame:
    """``(source, pages)``: how many documents each sound answer gives, 0 for one without pages.

    Counted where the answer is, before pages become rows.
    """
    checked = check_responses(responses, CHECKED_RESPONSE)
    pages = F.when(F.col("kind") == "pdf", F.size("pages")).otherwise(1).cast("bigint")
    counts = F.when(F.col("fault").isNull(), F.array(pages))
    return checked.select("source", F.explode(counts).alias("pages"))
