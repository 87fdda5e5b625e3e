"""Options and checks of the page-to-image step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.columns import ColumnOrName, col

# Defaults of the page-to-image step.
DEFAULT_SCALE = 2.0
DEFAULT_FORMAT = "png"
DEFAULT_QUALITY = 100
DEFAULT_PAGE = 1

# Message layers, outermost last.
IMAGE_PROCESSING_FAILED = "Image processing failed: "
PAGE_CONVERSION_FAILED = "Failed to convert PDF to image: "
FILE_CONVERSION_FAILED = "Failed to convert PDF to images: "


def _number_or(value: Column, default: Column) -> Column:
    # Zero and NaN count as not given.
    number = value.cast("double")
    return F.when(number.isNull() | (number == 0) | F.isnan(number), default).otherwise(value)


def render_options(
    scale: ColumnOrName, output_format: ColumnOrName, quality: ColumnOrName, page_number: ColumnOrName
) -> Column:
    """Options with defaults for everything empty: NULL, 0 or ``""``."""
    return F.struct(
        _number_or(col(scale), F.lit(DEFAULT_SCALE)).cast("double").alias("scale"),
        F.coalesce(F.nullif(col(output_format), F.lit("")), F.lit(DEFAULT_FORMAT)).alias("output_format"),
        _number_or(col(quality), F.lit(DEFAULT_QUALITY)).cast("int").alias("quality"),
        _number_or(col(page_number), F.lit(DEFAULT_PAGE)).cast("int").alias("page_number"),
    )


def page_bounds_error(page_number: ColumnOrName, num_pages: ColumnOrName) -> Column:
    """Message for a page the file does not have, else NULL."""
    page, pages = col(page_number), col(num_pages)
    message = F.concat(
        F.lit("Invalid page number: "),
        page.cast("string"),
        F.lit(". PDF has "),
        pages.cast("string"),
        F.lit(" pages."),
    )
    return F.when((page < 1) | (page > pages), message)


def conversion_error(message: ColumnOrName, whole_file: bool = False) -> Column:
    """A page error as the caller of the conversion sees it."""
    wrapped = F.concat(F.lit(PAGE_CONVERSION_FAILED), col(message))
    if whole_file:
        wrapped = F.concat(F.lit(FILE_CONVERSION_FAILED), wrapped)
    return wrapped


def page_limit(num_pages: ColumnOrName, max_pages: int) -> Column:
    """How many leading pages are rendered; 0 or less means all."""
    pages = col(num_pages)
    return pages if max_pages <= 0 else F.least(F.lit(max_pages), pages)
