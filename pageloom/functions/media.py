"""Media type, data URI and request expressions over file bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.columns import ColumnOrName, col

Transcoder = Callable[[Column], Column]

# Media types and the leading bytes (hex) that select them.
MIME_PNG = "image/png"
MIME_JPEG = "image/jpeg"
MIME_WEBP = "image/webp"
MIME_TIFF = "image/tiff"
MIME_PDF = "application/pdf"
MAGIC_JPEG = "FFD8"
MAGIC_WEBP = "5249"
MAGIC_TIFF_INTEL = "49492A00"
MAGIC_TIFF_MOTOROLA = "4D4D002A"


def sniff_mime(content: ColumnOrName) -> Column:
    """Media type by leading bytes; whatever is not recognised counts as PNG."""
    head = F.hex(F.substring(col(content), 1, 4))
    return (
        F.when(head.startswith(MAGIC_JPEG), MIME_JPEG)
        .when(head.startswith(MAGIC_WEBP), MIME_WEBP)
        .when(head.isin(MAGIC_TIFF_INTEL, MAGIC_TIFF_MOTOROLA), MIME_TIFF)
        .otherwise(MIME_PNG)
    )


def transcoded(content: ColumnOrName, mime: ColumnOrName, transcoder: Transcoder | None = None) -> Column:
    """``struct(content, mime)`` after the optional TIFF to JPEG step.

    ``transcoder`` maps TIFF bytes to JPEG bytes, or NULL where it fails; it
    sees NULL for rows that are not TIFF. It may be a built-in expression or a
    pandas UDF. Bytes and type stay as they are without one or on failure.
    """
    content, mime = col(content), col(mime)
    if transcoder is None:
        return F.struct(content.alias("content"), mime.alias("mime"))
    is_tiff = mime == MIME_TIFF
    jpeg = F.when(is_tiff, transcoder(F.when(is_tiff, content)))
    return F.struct(
        F.coalesce(jpeg, content).alias("content"),
        F.when(jpeg.isNotNull(), F.lit(MIME_JPEG)).otherwise(mime).alias("mime"),
    )


def data_uri(mime: ColumnOrName, content: ColumnOrName) -> Column:
    # base64() breaks its output into lines with CRLF; a data URI has none.
    payload = F.replace(F.base64(col(content)), F.lit("\r\n"), F.lit(""))
    return F.concat(F.lit("data:"), col(mime), F.lit(";base64,"), payload)


def ocr_request(kind: ColumnOrName, uri: ColumnOrName, model: str) -> Column:
    """The service request as JSON; absent keys are left out."""
    is_pdf = col(kind) == "pdf"
    document = F.struct(
        F.when(is_pdf, "document_url").otherwise("image_url").alias("type"),
        F.when(is_pdf, col(uri)).alias("documentUrl"),
        F.when(~is_pdf, col(uri)).alias("imageUrl"),
    )
    return F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            document.alias("document"),
            F.lit(True).alias("includeImageBase64"),
        )
    )
