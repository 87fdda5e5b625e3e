"""Document ingestion on Spark: files to page documents, at any scale."""

from pageloom.operators.text_items import Page, Renderer, parse_pdf, parse_pdf_parts, text_lines
from pageloom.options import DEFAULT_SUPPORTED_TYPES, LoadOptions
from pageloom.plans.load import (
    LoadError,
    LoadResult,
    load_path,
    load_requested,
    load_responses,
    load_stored,
    load_table,
)
from pageloom.plans.page_images import convert_pages, save_pdf_pages
from pyspark import cloudpickle as _cloudpickle

# Functions sent to executors carry their code, so the package need not be
# installed there.
import pageloom as _self

_cloudpickle.register_pickle_by_value(_self)

__all__ = [
    "DEFAULT_SUPPORTED_TYPES",
    "LoadError",
    "LoadOptions",
    "LoadResult",
    "Page",
    "Renderer",
    "convert_pages",
    "load_path",
    "load_requested",
    "load_responses",
    "load_stored",
    "load_table",
    "parse_pdf",
    "parse_pdf_parts",
    "save_pdf_pages",
    "text_lines",
]
