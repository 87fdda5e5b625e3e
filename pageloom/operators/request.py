"""Admitted files to service requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.columns import column_or_null
from pageloom.functions.media import MIME_PDF, Transcoder, data_uri, ocr_request, sniff_mime, transcoded
from pageloom.options import LoadOptions


def media(admitted: DataFrame, transcoder: Transcoder | None = None) -> DataFrame:
    """Replace ``content`` by the bytes to send and add their ``mime``.

    PDFs are sent as they are under a fixed type; the extension of an image
    does not matter, only its leading bytes.
    """
    image = transcoded("content", sniff_mime("content"), transcoder)
    return (
        admitted.withColumn("media", image)
        .withColumn("mime", F.when(F.col("kind") == "pdf", MIME_PDF).otherwise(F.col("media.mime")))
        .withColumn("content", F.when(F.col("kind") == "pdf", F.col("content")).otherwise(F.col("media.content")))
        .drop("media")
    )


def build_requests(
    admitted: DataFrame, options: LoadOptions = LoadOptions(), transcoder: Transcoder | None = None
) -> DataFrame:
    """One request per file; the bytes stay behind.

    A refused file keeps its row, with no request and the reason in
    ``refused``: sending, answers and refusals all come from one pass over the
    bytes.
    """
    sent = media(admitted, transcoder)
    request = ocr_request("kind", data_uri("mime", "content"), options.model)
    refused = column_or_null(admitted, "error", T.StringType()).alias("refused")
    return sent.select(
        "source", "kind", "extra", "loc", "pdf", refused, F.when(F.col("refused").isNull(), request).alias("request")
    )
