"""Pages rendered a block at a time: a file is opened once for many of its pages."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pageloom.functions.render import PAGE_CONVERSION_FAILED
from pageloom.operators.images import BLOCK_PAGES, page_blocks

# A file, some of its pages (from 1, ascending) and a scale to their PNG bytes, in
# that order; None for a page that fails. Raises where no page can be had any more.
PageRenderer = Callable[[str, list[int], float], Iterable[bytes | None]]
RendererFactory = Callable[[], PageRenderer]

# Bytes of images per Arrow batch handed back to Spark.
BATCH_BYTES = 32 << 20


def render_blocks(
    files: DataFrame,
    renderer: RendererFactory,
    scale: float,
    block_pages: int = BLOCK_PAGES,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Every page 1..``num_pages`` of the files with ``page_no``, ``content`` and ``error``; other columns repeat.

    The factory runs once per task and its renderer is called once for each
    block of a file's pages, so it opens the file once. It should yield images
    as they are made: those that together reach ``batch_bytes`` are passed on.
    If it raises, the pages that it has not yielded have the error; pages that
    it leaves out have neither content nor error.
    """
    blocks = page_blocks(files, block_pages)
    names = files.columns
    added = [T.StructField("page_no", T.IntegerType()), T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())]
    schema = T.StructType([*[files.schema[name] for name in names], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = renderer()
        for batch in batches:
            held, at, pages, contents, errors = 0, [], [], [], []

            def rows():
                columns = [batch.column(name).take(pa.array(at, pa.int64())) for name in names]
                columns += [pa.array(pages, pa.int32()), pa.array(contents, pa.binary()), pa.array(errors, pa.string())]
                return pa.RecordBatch.from_arrays(columns, schema_names)

            places = zip(*(batch.column(c).to_pylist() for c in ("source", "first_page", "last_page")))
            for i, (source, first, last) in enumerate(places):
                wanted = list(range(first, last + 1))
                images, failure = iter(()), None
                try:
                    images = iter(render(source, wanted, scale))
                except Exception as problem:  # a file that can't be read is data here
                    failure = PAGE_CONVERSION_FAILED + str(problem)
                for page in wanted:
                    image = None
                    if failure is None:
                        try:
                            image = next(images, None)
                        except Exception as problem:
                            failure = PAGE_CONVERSION_FAILED + str(problem)
                    at.append(i)
                    pages.append(page)
                    contents.append(image)
                    errors.append(failure)
                    held += len(image or b"")
                    if held >= batch_bytes:
                        yield rows()
                        held, at, pages, contents, errors = 0, [], [], [], []
            if at:
                yield rows()

    schema_names = schema.names
    return blocks.mapInArrow(run, schema)
