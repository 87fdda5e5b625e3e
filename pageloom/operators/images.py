"""Pages to images: fan-out, naming and format dispatch.

Rendering and encoding are hooks; the operators plan what is to be rendered
and encoded, for which file and page, and where it goes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.render import IMAGE_PROCESSING_FAILED, conversion_error, page_bounds_error, render_options
from pageloom.session import spread

# Image bytes, format and quality to encoded bytes; NULL where it fails.
Encoder = Callable[[Column, Column, Column], Column]

# Pages of one file that are rendered together.
BLOCK_PAGES = 256


@dataclass(frozen=True)
class ImageFormat:
    ext: str
    quality: int | None = None


NOT_RENDERED = "page was not rendered"

# Formats a sample page is written in.
SAMPLE_FORMATS = (ImageFormat("jpg", 90), ImageFormat("png"), ImageFormat("webp", 90))


def page_blocks(files: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """Add ``first_page`` and ``last_page``: one row per run of pages.

    A block is the unit a rendering hook opens a file for. Blocks are spread
    while they are still single short rows, so a file with very many pages is
    not rendered by one task.
    """
    pages = F.col("num_pages").cast("int")
    starts = F.when(pages >= 1, F.sequence(F.lit(1), pages, F.lit(block_pages)))
    blocks = files.withColumn("first_page", F.explode(starts)).withColumn(
        "last_page", F.least(F.col("first_page") + (block_pages - 1), pages)
    )
    return spread(blocks)


def page_fanout(files: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """One row per page 1..``num_pages``; all other columns repeat."""
    blocks = page_blocks(files, block_pages)
    return blocks.withColumn("page_no", F.explode(F.sequence("first_page", "last_page"))).drop(
        "first_page", "last_page"
    )


def apply_render_options(requests: DataFrame) -> DataFrame:
    """Fill ``scale, output_format, quality, page_number`` with their defaults."""
    names = ("scale", "output_format", "quality", "page_number")
    filled = requests.withColumn("options", render_options(*names))
    others = [name for name in requests.columns if name not in names]
    return filled.select(*others, *[f"options.{name}" for name in names])


def page_bounds(requests: DataFrame, whole_file: bool = False) -> DataFrame:
    """Add ``error`` to page requests outside ``1..num_pages``.

    Options are filled first: page 0 asks for page 1 and is no error.
    """
    error = page_bounds_error("page_number", "num_pages")
    return apply_render_options(requests).withColumn("error", conversion_error(error, whole_file))


def format_fanout(images: DataFrame, formats: Sequence[ImageFormat] = SAMPLE_FORMATS) -> DataFrame:
    """Each image once per format, as ``fmt``, ``quality`` and ``file_name``."""
    choices = F.array(
        *[
            F.struct(F.lit(fmt.ext).alias("fmt"), F.lit(fmt.quality).cast("int").alias("quality"))
            for fmt in formats
        ]
    )
    return (
        images.withColumn("choice", F.explode(choices))
        .withColumn("fmt", F.col("choice.fmt"))
        .withColumn("quality", F.col("choice.quality"))
        .withColumn("file_name", F.concat(F.lit("sample."), F.col("fmt")))
        .drop("choice")
    )


def format_dispatch(images: DataFrame, encoder: Encoder | None = None) -> DataFrame:
    """Pass PNG through, hand other formats to the encoder.

    Adds ``needs_encode`` and ``error`` and replaces ``content``. Rows left
    without bytes get an error, unless they come with one; without an encoder
    these are all rows that need one.
    """
    needs_encode = F.col("fmt") != "png"
    drawn = F.col("drawn")
    if encoder is None:
        encoded = F.lit(None).cast("binary")
    else:
        encoded = encoder(F.when(needs_encode, drawn), F.col("fmt"), F.col("quality"))
    failed = F.concat(F.lit(IMAGE_PROCESSING_FAILED), F.lit("cannot encode as "), F.col("fmt"))
    error = F.when(drawn.isNull(), conversion_error(F.lit(NOT_RENDERED))).when(
        F.col("content").isNull(), conversion_error(failed)
    )
    if "error" in images.columns:
        error = F.coalesce(F.col("error"), error)
    return (
        images.withColumnRenamed("content", "drawn")
        .withColumn("needs_encode", needs_encode)
        .withColumn("content", F.when(needs_encode, encoded).otherwise(drawn))
        .withColumn("error", error)
        .drop("drawn")
    )
