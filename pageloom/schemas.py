"""Column types shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

LOC = T.StructType([T.StructField("pageNumber", T.IntegerType())])

DIMENSIONS = T.StructType([
    T.StructField("dpi", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
])

# One region as the OCR service spells it. Numbers are read as doubles: as
# integers, a value written with a fraction such as 10.0 would be lost.
RESPONSE_IMAGE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("topLeftX", T.DoubleType()),
    T.StructField("topLeftY", T.DoubleType()),
    T.StructField("bottomRightX", T.DoubleType()),
    T.StructField("bottomRightY", T.DoubleType()),
    T.StructField("imageBase64", T.StringType()),
])

RESPONSE_DIMENSIONS = T.StructType([
    T.StructField("dpi", T.DoubleType()),
    T.StructField("height", T.DoubleType()),
    T.StructField("width", T.DoubleType()),
])

RESPONSE_PAGE = T.StructType([
    T.StructField("markdown", T.StringType()),
    T.StructField("images", T.ArrayType(RESPONSE_IMAGE)),
    T.StructField("dimensions", RESPONSE_DIMENSIONS),
])

RESPONSE = T.StructType([T.StructField("pages", T.ArrayType(RESPONSE_PAGE))])



def _answer(*fields: T.StructField) -> T.StructType:
    """An answer read only as far as is needed: what is not named is skipped, images' base64 above all."""
    # Of regions it matters whether one is null.
    region = T.StructType([T.StructField("id", T.StringType())])
    page = T.StructType([*fields, T.StructField("images", T.ArrayType(region))])
    return T.StructType([T.StructField("pages", T.ArrayType(page))])


# Enough to check an answer and count its pages; enough for the text of its pages as well.
CHECKED_RESPONSE = _answer()
TEXT_RESPONSE = _answer(T.StructField("markdown", T.StringType()))

# One region as a document carries it.
REGION = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("top_left_x", T.IntegerType()),
    T.StructField("top_left_y", T.IntegerType()),
    T.StructField("bottom_right_x", T.IntegerType()),
    T.StructField("bottom_right_y", T.IntegerType()),
    T.StructField("image_base64", T.StringType()),
])

STRING_MAP = T.MapType(T.StringType(), T.StringType())
# Keys whose values have types of their own: numbers, booleans, lists, objects.
OPEN_MAP = T.MapType(T.StringType(), T.VariantType())


def pdf_type(keys: T.MapType) -> T.StructType:
    """``version`` is that of the extracting library, not of the PDF file."""
    return T.StructType([
        T.StructField("version", T.StringType()),
        T.StructField("info", keys),
        T.StructField("metadata", keys),
        T.StructField("totalPages", T.IntegerType()),
        T.StructField("loc", LOC),
    ])


PDF, OPEN_PDF = pdf_type(STRING_MAP), pdf_type(OPEN_MAP)

# ``images`` is NULL only on combined documents, where images and dimensions
# are absent; elsewhere it is a list (maybe empty) and ``dimensions`` an
# explicit null when the service gave none. ``extra`` is OPEN_MAP and ``pdf``
# OPEN_PDF where the caller's values, or the PDF's, are typed.
METADATA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("images", T.ArrayType(REGION)),
    T.StructField("dimensions", DIMENSIONS),
    T.StructField("loc", LOC),
    T.StructField("pdf", PDF),
    T.StructField("extra", STRING_MAP),
])

# What every source hands to admission.
FILES = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("extra", STRING_MAP),
    T.StructField("loc", LOC),
    T.StructField("pdf", PDF),
    T.StructField("error", T.StringType()),
])

REJECTS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("error", T.StringType()),
])
