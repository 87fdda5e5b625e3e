"""PDF pages to images and image files."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.render import (
    DEFAULT_FORMAT,
    DEFAULT_QUALITY,
    DEFAULT_SCALE,
    FILE_CONVERSION_FAILED,
)
from pageloom.operators.images import Encoder, format_dispatch, page_bounds, page_fanout
from pageloom.operators.rendering import RendererFactory, render_blocks
from pageloom.session import materialize
from pageloom.sources.blobs import fail_on_shared_paths, hidden_path, placed_images, put, sweep
from pageloom.sources.systems import Systems, default_system

SHORT = ("source", "page_no", "path", "error")

# Source, page number and scale to PNG bytes; NULL where it fails.
Rasterizer = Callable[[Column, Column, Column], Column]

def convert_pages(requests: DataFrame, rasterize: Rasterizer, encoder: Encoder | None = None) -> DataFrame:
    """Render requested pages: adds ``content`` and ``error`` to each request.

    A request is ``(source, num_pages, scale, output_format, quality,
    page_number)``, options empty where the default is meant. Pages the file
    does not have are not rendered.
    """
    checked = page_bounds(requests)
    drawn = rasterize(F.col("source"), F.col("page_number"), F.col("scale"))
    images = checked.withColumn("content", F.when(F.col("error").isNull(), drawn)).withColumn(
        "fmt", F.col("output_format")
    )
    return format_dispatch(images, encoder).drop("fmt", "needs_encode")


def save_pdf_pages(
    files: DataFrame,
    directory: str,
    rasterize: Rasterizer | None = None,
    encoder: Encoder | None = None,
    fmt: str | None = None,
    quality: int | None = None,
    scale: float | None = None,
    renderer: RendererFactory | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Write every page of ``files(source, num_pages[, dir])`` as an image.

    Returns ``(source, page_no, path)`` of the written pages and
    ``rejects(source, error)``. A file of which a page fails is rejected with
    the error of its first failing page, and none of its pages is written.

    Pages come from ``rasterize``, a column of each page, or from ``renderer``,
    which opens a file once for a block of its pages (``render_blocks``).

    Images are written once, under hidden names, by the task that makes them.
    Only short rows are brought together to find the failed files; then the
    images of the others are renamed and theirs are deleted. Images that lost
    or repeated tasks have left under hidden names are deleted in the end, also
    if the run fails. With a column ``dir`` pages go there below ``directory``,
    else to a folder of their file.
    """
    if (rasterize is None) == (renderer is None):
        raise ValueError("Either rasterize or renderer makes the pages")
    factor = float(scale or DEFAULT_SCALE)

    def placed(pages: DataFrame) -> DataFrame:
        pages = pages.withColumn("fmt", F.lit(fmt or DEFAULT_FORMAT))
        return placed_images(pages.withColumn("quality", F.lit(quality or DEFAULT_QUALITY)), directory)

    names = placed(page_fanout(files))
    fail_on_shared_paths(names)
    if renderer is None:
        drawn = names.withColumn("content", rasterize(F.col("source"), F.col("page_no"), F.lit(factor)))
    else:
        drawn = placed(render_blocks(files, renderer, factor))
    run = uuid.uuid4().hex
    try:
        return _written(format_dispatch(drawn, encoder), run)
    finally:
        sweep(names, run)


def _written(images: DataFrame, run: str) -> tuple[DataFrame, DataFrame]:
    """Write images to their paths, those of files without a failed page; the pages written and the files that failed."""
    default = default_system(images.sparkSession)

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        systems, made = Systems(default), set()
        for batch in batches:
            staged = []
            for path, content, error in zip(*(batch.column(c) for c in ("path", "content", "error"))):
                if error.is_valid:
                    staged.append(None)
                    continue
                staged.append(hidden_path(path.as_py(), run))
                system, target = systems.find(staged[-1])
                put(system, target, content.as_buffer(), made, run)
            kept = [batch.column(c) for c in ("source", "page_no", "path", "error")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(staged, pa.string())], [*SHORT, "staged"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        systems = Systems(default)
        for batch in batches:
            for path, staged, bad in zip(*(batch.column(c).to_pylist() for c in ("path", "staged", "bad"))):
                system, source = systems.find(staged)
                there = system.get_file_info(source).type == fs.FileType.File  # a repeated task finds it done
                if there and bad:
                    system.delete_file(source)
                elif there:
                    system.move(source, systems.find(path)[1])
            yield batch

    page_no = images.schema["page_no"].dataType.simpleString()
    rows = images.select(*SHORT, "content").mapInArrow(stage, f"source string, page_no {page_no}, path string, error string, staged string")
    rows = materialize(rows, "page-images")
    failed = (
        rows.filter(F.col("error").isNotNull())
        .groupBy("source")
        .agg(F.concat(F.lit(FILE_CONVERSION_FAILED), F.min_by("error", "page_no")).alias("error"))
    )
    bad = failed.select("source", F.lit(True).alias("failed"))
    marked = rows.where(F.col("staged").isNotNull()).join(bad, "source", "left")
    marked = marked.select("source", "page_no", "path", "staged", F.coalesce("failed", F.lit(False)).alias("bad"))
    done = materialize(marked.mapInArrow(finish, marked.schema), "page-files")
    return done.where(~F.col("bad")).select("source", "page_no", "path"), failed
