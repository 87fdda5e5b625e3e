"""Path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.columns import ColumnOrName, col


def file_ext(source: ColumnOrName) -> Column:
    """Lower-cased last extension with its dot.

    Empty for names without a dot, dot-files and ``..``; trailing slashes are
    ignored; a name that ends in a dot has the extension ``"."``.
    """
    source = col(source)
    ext = F.lower(F.regexp_extract(source, r"[^/](\.[^./]*)/*\z", 1))
    return F.when(source.rlike(r"(\A|/)\.\./*\z"), F.lit("")).otherwise(ext)


def plain_path(uri: ColumnOrName) -> Column:
    """Drop the ``file:`` scheme a file scan puts before local paths."""
    return F.regexp_replace(col(uri), r"\Afile:/+", "/")


def page_file_name(page_no: ColumnOrName, fmt: ColumnOrName) -> Column:
    return F.concat(F.lit("page-"), col(page_no).cast("string"), F.lit("."), col(fmt))


def page_file_path(directory: ColumnOrName, page_no: ColumnOrName, fmt: ColumnOrName) -> Column:
    """``<directory>/page-<n>.<format>``; slashes are not doubled."""
    directory = col(directory)
    name = page_file_name(page_no, fmt)
    trimmed = F.regexp_replace(directory, r"/+\z", "")
    return F.when(directory == "", name).otherwise(F.concat(trimmed, F.lit("/"), name))
