"""Text items of PDF pages to page text and document text.

Input is ``text_items(source, page_no, item_seq, str, y)`` in reading order of
``item_seq`` within a page; a missing ``y`` makes the page unreadable.

A page or a file may hold a large share of all items. Items are therefore cut
into chunks by their number and pages into parts; each chunk and each part
becomes one row where it lands, and only those rows are brought together. What
meets in one task is the one string it has to become.

Before anything moves, items that follow each other on one line become one
string, so that what moves is about the text and not a record for each word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.render import page_limit
from pageloom.operators.pdf_info import doc_info

# Most item numbers in one chunk, and most page numbers in one part.
CHUNK_ITEMS = 4096
PART_PAGES = 1024

# The reject of a file whose info is missing.
NO_INFO = "PDF info is missing"

# Written *before* every page of a file's text, the first one included.
PAGE_LEAD = "\n\n"
# Written before the text of an item on another line than the one before it.
LINE_BREAK = "\n"

# Between the items of a run; an item that holds it is a run of its own.
ITEM_MARK = "\x1f"
RUNS = "array<struct<item_seq: bigint, str: string, y: double, items: int>>"


@dataclass(frozen=True)
class Page:
    """What a custom renderer sees of a page.

    ``text`` is the default rendering. ``items``, the ordered
    ``array<struct<item_seq, str, y>>``, is there only if asked for with
    ``with_items``, as it makes every page carry its items.
    """

    source: Column
    page_no: Column
    text: Column
    items: Column | None = None


# Page to text; NULL means that rendering the page failed.
Renderer = Callable[[Page], Column]


def _same_line(y: Column, previous: Column) -> Column:
    # NaN is on no line, not even on that of another NaN.
    return (y == previous) & ~F.isnan(y)


def _listagg(column: str, order: str) -> Column:
    return F.expr(f"listagg({column}, '') within group (order by {order})")


def _joined(rows: Column, text: str, start_y: str, end_y: str) -> Column:
    """Texts of ordered rows, with a line break wherever a line does not run on."""
    return F.array_join(
        F.transform(
            rows,
            lambda row, i: F.when(
                (i == 0) | _same_line(row[start_y], F.get(rows, i - 1)[end_y]), row[text]
            ).otherwise(F.concat(F.lit(LINE_BREAK), row[text])),
        ),
        "",
    )


def item_runs(items: DataFrame, chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """``(source, page_no, chunk, runs)``: items that follow each other in the table, put together in place.

    A run ``(item_seq, str, y, items)`` holds items with numbers one after
    another and one ``y``; ``str`` is their texts with ``ITEM_MARK`` between
    them. A chunk may have several rows, with runs in any order. Items in no
    order at all are runs of one item.
    """
    rows = items.select(
        "source",
        "page_no",
        F.col("item_seq").cast("bigint").alias("item_seq"),
        F.coalesce("str", F.lit("")).alias("str"),
        F.col("y").cast("double").alias("y"),
    )
    keys, mark = ["source", "page_no"], ITEM_MARK
    made = [T.StructField("chunk", T.LongType()), T.StructField("runs", T.DataType.fromDDL(RUNS))]
    schema = T.StructType([*[rows.schema[key] for key in keys], *made])

    def starts(changed: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.concatenate(([True], changed)))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            seq, y = batch.column("item_seq"), batch.column("y")
            number, bits = seq.fill_null(0).to_numpy(), y.fill_null(0.0).to_numpy().view(np.int64)
            chunk = pa.array(np.floor(number / chunk_items).astype(np.int64), mask=seq.is_null().to_numpy(zero_copy_only=False))
            other = np.zeros(batch.num_rows - 1, bool)
            for key in (*(batch.column(key) for key in keys), chunk):
                codes = pc.dictionary_encode(key, null_encoding="encode").indices.to_numpy()
                other |= codes[1:] != codes[:-1]
            alone = pc.or_(pc.match_substring(batch.column("str"), mark), pc.or_(seq.is_null(), y.is_null(nan_is_null=True)))
            alone = alone.to_numpy(zero_copy_only=False)
            broken = other | (number[1:] != number[:-1] + 1) | (bits[1:] != bits[:-1]) | alone[1:] | alone[:-1]
            chunk_at, run_at = starts(other), starts(broken)
            ends = np.append(run_at, batch.num_rows)
            texts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), batch.column("str"))
            first, sizes = pa.array(run_at), pa.array(np.diff(ends), pa.int32())
            runs = [seq.take(first), pc.binary_join(texts, mark), y.take(first), sizes]
            runs = pa.StructArray.from_arrays(runs, ["item_seq", "str", "y", "items"])
            offsets = np.append(np.searchsorted(run_at, chunk_at), len(run_at))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs)
            columns = [column.take(pa.array(chunk_at)) for column in (*(batch.column(key) for key in keys), chunk)]
            yield pa.RecordBatch.from_arrays([*columns, lists], schema.names)

    return rows.mapInArrow(gather, schema)


def _run_items(run: Column) -> Column:
    """The items of a run."""
    texts = F.when(run["items"] == 1, F.array(run["str"])).otherwise(F.split(run["str"], ITEM_MARK, -1))
    return F.transform(texts, lambda text, i: F.struct((run["item_seq"] + i).alias("item_seq"), text.alias("str"), run["y"].alias("y")))


def text_chunks(items: DataFrame, chunk_items: int = CHUNK_ITEMS, with_items: bool = False) -> DataFrame:
    """``(source, page_no, chunk, body, first_y, last_y, broken[, items])``.

    Runs of items are gathered per chunk. A chunk is bounded by its item
    numbers, which are integers. Runs are taken apart only where their numbers
    overlap, or for ``with_items``.
    """
    gathered = (
        item_runs(items, chunk_items)
        .groupBy("source", "page_no", "chunk")
        .agg(F.sort_array(F.flatten(F.collect_list("runs"))).alias("runs"))
    )
    runs = F.col("runs")
    single = F.sort_array(F.flatten(F.transform(runs, _run_items)))
    whole = F.transform(
        runs,
        lambda run: F.struct(
            run["item_seq"].alias("item_seq"),
            F.when(run["items"] == 1, run["str"]).otherwise(F.replace(run["str"], F.lit(ITEM_MARK), F.lit(""))).alias("str"),
            run["y"].alias("y"),
        ),
    )

    def begins_inside(run: Column, i: Column) -> Column:
        before = F.get(runs, i - 1)
        return run["item_seq"] < before["item_seq"] + before["items"]

    overlap = F.size(F.filter(runs, begins_inside)) > 0
    placed = gathered.withColumn("items", single if with_items else F.when(overlap, single).otherwise(whole))
    number = items.schema["item_seq"].dataType
    listed = F.transform(
        "items", lambda item: F.struct(item["item_seq"].cast(number).alias("item_seq"), item["str"].alias("str"), item["y"].alias("y"))
    )
    return placed.select(
        "source",
        "page_no",
        "chunk",
        _joined(F.col("items"), "str", "y", "y").alias("body"),
        F.get("items", F.lit(0))["y"].alias("first_y"),
        F.element_at("items", -1)["y"].alias("last_y"),
        F.exists("items", lambda item: item["y"].isNull()).alias("broken"),
        *([listed.alias("items")] if with_items else []),
    )


def _page_aggregates(with_items: bool) -> list[Column]:
    """Of chunk rows: the ordered chunks with a body, and whether one is broken."""
    chunk = F.struct("chunk", "body", "first_y", "last_y", *(["items"] if with_items else []))
    return [
        F.sort_array(F.collect_list(F.when(F.col("body").isNotNull(), chunk))).alias("chunks"),
        F.max("broken").alias("broken"),
    ]


def _page_body() -> Column:
    joined = _joined(F.col("chunks"), "body", "first_y", "last_y")
    return F.when(F.col("broken"), F.lit("")).otherwise(joined)


def _page_columns(with_items: bool) -> list[Column]:
    items = F.flatten(F.transform("chunks", lambda chunk: chunk["items"])).alias("items")
    return [_page_body().alias("text"), *([items] if with_items else [])]


def chunks_to_pages(chunks: DataFrame) -> DataFrame:
    """``(source, page_no, text[, items])``: chunks joined where a line runs on or breaks.

    A page whose items cannot all be placed has the empty text.
    """
    with_items = "items" in chunks.columns
    pages = chunks.groupBy("source", "page_no").agg(*_page_aggregates(with_items))
    return pages.select("source", "page_no", *_page_columns(with_items))


def text_lines(items: DataFrame, chunk_items: int = CHUNK_ITEMS, with_items: bool = False) -> DataFrame:
    """Page text, items on one line run together and lines broken.

    A line ends where ``y`` differs from that of the item before; coming back
    to an earlier ``y`` starts a new line.
    """
    return chunks_to_pages(text_chunks(items, chunk_items, with_items))


def page_lines(pages: DataFrame, with_items: bool = False) -> DataFrame:
    """``(source, page_no, text[, items])`` of pages that hold their items.

    Input is ``pages(source, page_no, items)``, items an ``array<struct<str, y>>``
    in reading order, as an extractor gives them. Row by row: nothing is
    shuffled or gathered, and a renderer may look at ``items``.
    """
    placed = F.transform(
        F.coalesce("items", F.array()),
        lambda item, i: F.struct(
            i.cast("bigint").alias("item_seq"),
            F.coalesce(item["str"], F.lit("")).alias("str"),
            item["y"].cast("double").alias("y"),
        ),
    )
    rows = pages.select("source", "page_no", placed.alias("items"))
    broken = F.exists("items", lambda item: item["y"].isNull())
    text = F.when(broken, F.lit("")).otherwise(_joined(F.col("items"), "str", "y", "y"))
    return rows.select("source", "page_no", text.alias("text"), *(["items"] if with_items else []))


def _page_of(pages: DataFrame) -> Page:
    items = F.col("items") if "items" in pages.columns else None
    return Page(F.col("source"), F.col("page_no"), F.col("text"), items)


def custom_renderer(pages: DataFrame, renderer: Renderer) -> DataFrame:
    """Replace page text by a caller's expression over the page.

    The renderer may be built in or wrap a pandas UDF. Pages it returns NULL
    for are dropped, separator and all.
    """
    rendered = pages.withColumn("text", renderer(_page_of(pages))).filter(F.col("text").isNotNull())
    return rendered.drop("items")


def limit_pages(rows: DataFrame, max_pages: int) -> DataFrame:
    """Rows of the first pages only; 0 or less keeps all."""
    return rows if max_pages <= 0 else rows.filter(F.col("page_no") <= max_pages)


def page_counts(pages: DataFrame, max_pages: int = 0) -> DataFrame:
    """``numpages`` and ``numrender`` per file, failed pages included."""
    counted = pages.groupBy("source").agg(F.count(F.lit(1)).cast("int").alias("numpages"))
    return counted.withColumn("numrender", page_limit("numpages", max_pages))


def _part(part_pages: int) -> Column:
    if part_pages <= 0:
        return F.lit(0).cast("bigint")
    return F.floor((F.coalesce(F.col("page_no"), F.lit(1)) - 1) / part_pages)


def document_parts(pages: DataFrame, part_pages: int = PART_PAGES) -> DataFrame:
    """``(source, part, text)``: a file's text in runs of pages.

    The parts of a file in order make up its text. This is the form for files
    whose text would not fit in one value. A page whose text is NULL has
    failed and gives no piece; a part of failed pages only is empty.
    """
    return (
        pages.select(
            "source",
            _part(part_pages).alias("part"),
            "page_no",
            F.concat(F.lit(PAGE_LEAD), F.col("text")).alias("piece"),
        )
        .groupBy("source", "part")
        .agg(F.coalesce(_listagg("piece", "page_no"), F.lit("")).alias("text"))
    )


def document_text(pages: DataFrame, part_pages: int = PART_PAGES) -> DataFrame:
    """``(source, text)``: every page text preceded by a blank line."""
    return (
        document_parts(pages, part_pages).groupBy("source").agg(_listagg("text", "part").alias("text"))
    )


def combine_page_table(pages: DataFrame, part_pages: int = PART_PAGES) -> DataFrame:
    """``(source, text)`` with the blank line *between* pages only.

    For pages that are already rows; from a stored answer combine the array.
    A page without text is an empty one and keeps its place.
    """
    joined = document_text(pages.withColumn("text", F.coalesce("text", F.lit(""))), part_pages)
    return joined.withColumn("text", F.substring("text", F.lit(len(PAGE_LEAD) + 1), F.length("text")))


def without_info(items: DataFrame, pdf_info: DataFrame) -> DataFrame:
    """``rejects(source, error)`` of files that have items but no info, which parsing leaves out."""
    files = items.select("source").distinct().join(pdf_info.select("source"), "source", "left_anti")
    return files.select("source", F.lit(NO_INFO).alias("error"))


def parse_pdf_parts(
    items: DataFrame,
    pdf_info: DataFrame,
    max_pages: int = 0,
    renderer: Renderer | None = None,
    with_items: bool = False,
    chunk_items: int = CHUNK_ITEMS,
    part_pages: int = PART_PAGES,
) -> DataFrame:
    """``(source, part, text, header)``: parsed files in runs of pages.

    Text moves twice: items by chunk, then chunks by part. Every page is also
    a row without a body in that second exchange, the first one with the
    file's info; so pages without items are kept and nothing is joined.
    ``header`` is set on a file's part 0 and nowhere if it has no info. With
    ``part_pages=0`` a file is one part.
    """
    info = doc_info(pdf_info)
    chunks = text_chunks(limit_pages(items, max_pages), chunk_items, with_items)
    count = page_limit("num_pages", max_pages)
    numbers = F.explode_outer(F.when(count >= 1, F.sequence(F.lit(1), count)))
    header = F.struct("version", "info", "metadata", "num_pages")
    blank = info.select("source", header.alias("header"), numbers.alias("page_no")).select(
        "source",
        F.col("page_no").cast(chunks.schema["page_no"].dataType).alias("page_no"),
        F.lit(-1).cast("bigint").alias("chunk"),
        F.lit(True).alias("listed"),
        # On the first page's row, or the only one of a file without pages.
        F.when(F.coalesce(F.col("page_no"), F.lit(1)) == 1, F.col("header")).alias("header"),
    )
    together = (
        chunks.unionByName(blank, allowMissingColumns=True)
        .withColumn("part", _part(part_pages))
        # Named, so that pages and then parts are put together in place.
        .repartition("source", *(["part"] if part_pages > 0 else []))
    )
    pages = (
        together.groupBy("source", "part", "page_no")
        .agg(*_page_aggregates(with_items), F.first("header", ignorenulls=True).alias("header"), F.max("listed").alias("listed"))
        # Items beyond the file's pages, or of a file without info, belong to no page.
        .filter(F.col("listed"))
        .select("source", "part", "page_no", "header", *_page_columns(with_items))
    )
    if renderer is not None:
        pages = pages.withColumn("text", renderer(_page_of(pages)))
    # A page whose rendering failed has no piece, which leaves out its lead too.
    piece = F.when(F.col("page_no").isNotNull(), F.concat(F.lit(PAGE_LEAD), F.col("text")))
    return (
        pages.withColumn("piece", piece)
        .groupBy("source", "part")
        .agg(
            F.coalesce(_listagg("piece", "page_no"), F.lit("")).alias("text"),
            F.first("header", ignorenulls=True).alias("header"),
        )
    )


def parse_pdf(
    items: DataFrame,
    pdf_info: DataFrame,
    max_pages: int = 0,
    renderer: Renderer | None = None,
    with_items: bool = False,
    chunk_items: int = CHUNK_ITEMS,
    part_pages: int = PART_PAGES,
) -> DataFrame:
    """One row per file: ``source, numpages, numrender, info, metadata, text, version``.

    Puts the parts of each file together; all the work per item and per page
    is done before, spread over parts. Where no file holds a large share of
    all pages, ``part_pages=0`` saves that last exchange.
    """
    parts = parse_pdf_parts(items, pdf_info, max_pages, renderer, with_items, chunk_items, part_pages)
    texts = parts.groupBy("source").agg(
        _listagg("text", "part").alias("text"), F.first("header", ignorenulls=True).alias("header")
    )
    num_pages = F.col("header.num_pages")
    return texts.filter(F.col("header").isNotNull()).select(
        "source",
        num_pages.alias("numpages"),
        page_limit(num_pages, max_pages).alias("numrender"),
        "header.info",
        "header.metadata",
        "text",
        "header.version",
    )
