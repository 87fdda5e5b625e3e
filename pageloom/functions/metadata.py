"""Metadata merging: what the engine computes wins over what the caller gave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.columns import ColumnOrName, col, column_or_null
from pageloom.schemas import LOC, OPEN_MAP, OPEN_PDF, PDF, STRING_MAP

# Keys the engine sets itself on every page document.
PAGE_KEYS = ("images", "dimensions")
# Keys that live in columns of their own instead of ``extra``.
COLUMN_KEYS = ("source", "loc", "pdf")


def caller_keys(df: DataFrame, name: str) -> Column:
    """Keys of any kind as a map: of strings where the caller has strings, else of typed values.

    A map of other values, a struct (its fields), or a VARIANT that holds an
    object become a map of VARIANT, whose numbers, booleans, lists and objects
    stay what they are. Keys of a map or a struct keep their order; those of a
    VARIANT, and of objects inside a value, are sorted.
    A VARIANT that is no object has no keys: it gives NULL.
    """
    kind = df.schema[name].dataType if name in df.columns else None
    if kind is None or isinstance(kind, T.NullType) or kind == STRING_MAP:
        return column_or_null(df, name, STRING_MAP)
    keys = F.col(name)

    def typed(value: Column, kind: T.DataType) -> Column:
        nested = isinstance(kind, (T.StructType, T.MapType, T.ArrayType))
        return F.to_variant_object(value) if nested else value.cast(T.VariantType())

    if isinstance(kind, T.VariantType):
        keys = F.try_variant_get(keys, "$", OPEN_MAP.simpleString())
    elif isinstance(kind, T.StructType):
        members = [F.create_map(F.lit(f.name), typed(keys[f.name], f.dataType)) for f in kind.fields]
        keys = F.when(keys.isNotNull(), F.map_concat(*members))
    elif isinstance(kind, T.MapType) and not isinstance(kind.valueType, T.VariantType):
        keys = F.transform_values(keys, lambda _, v: typed(v, kind.valueType))
    return keys.cast(OPEN_MAP).alias(name)


def without_keys(extra: ColumnOrName, keys: tuple[str, ...]) -> Column:
    return F.map_filter(col(extra), lambda key, _: ~key.isin(*keys))


def merged_extra(extra: ColumnOrName) -> Column:
    """Caller keys of a page document: those the engine computes are dropped."""
    return without_keys(extra, PAGE_KEYS)


def _held(extra: Column, key: str, dtype: T.StructType, typed: bool) -> Column:
    """A struct under a caller's key: an object of a typed value, or JSON text."""
    value = F.try_element_at(extra, F.lit(key))
    if not typed:
        return F.from_json(value, dtype)
    text = F.try_variant_get(value, "$", "string")
    return F.when(
        F.schema_of_variant(value).startswith("OBJECT"), F.try_variant_get(value, "$", dtype.simpleString())
    ).otherwise(F.try_variant_get(F.try_parse_json(text), "$", dtype.simpleString()))


def caller_loc(loc: Column, extra: Column, typed: bool = False) -> Column:
    """The caller's location, a column or under ``extra.loc``; ``typed`` says that the keys hold VARIANT."""
    return F.coalesce(loc, _held(extra, "loc", LOC, typed))


def caller_pdf(pdf: Column, extra: Column, typed: bool = False) -> Column:
    """The caller's PDF info, a column or under ``extra.pdf``, with typed info if the keys are."""
    kind = OPEN_PDF if typed else PDF
    return F.coalesce(pdf.cast(kind), _held(extra, "pdf", kind, typed))


def page_loc(page_no: ColumnOrName) -> Column:
    return F.struct(col(page_no).cast("int").alias("pageNumber"))


def image_loc(loc: ColumnOrName) -> Column:
    """Location of an image document: page 1 unless the caller gave one."""
    return F.coalesce(col(loc), page_loc(F.lit(1)))


def pdf_loc(pdf: ColumnOrName, page_no: ColumnOrName) -> Column:
    """PDF metadata with the page number set, made afresh when there is none."""
    pdf = col(pdf)
    return F.struct(
        pdf["version"].alias("version"),
        pdf["info"].alias("info"),
        pdf["metadata"].alias("metadata"),
        pdf["totalPages"].alias("totalPages"),
        page_loc(page_no).alias("loc"),
    )
