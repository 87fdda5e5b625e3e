"""Image regions of a response page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.columns import ColumnOrName, col
from pageloom.schemas import DIMENSIONS, RESPONSE_IMAGE


def image_regions(images: ColumnOrName) -> Column:
    """Service regions under the document's names.

    Missing coordinates become 0, a missing payload stays NULL and a missing
    list becomes the empty list.
    """
    none = F.array().cast(T.ArrayType(RESPONSE_IMAGE))

    def coordinate(value: Column) -> Column:
        return F.coalesce(value.try_cast("int"), F.lit(0))

    return F.transform(
        F.coalesce(col(images), none),
        lambda image: F.struct(
            image["id"].alias("id"),
            coordinate(image["topLeftX"]).alias("top_left_x"),
            coordinate(image["topLeftY"]).alias("top_left_y"),
            coordinate(image["bottomRightX"]).alias("bottom_right_x"),
            coordinate(image["bottomRightY"]).alias("bottom_right_y"),
            image["imageBase64"].alias("image_base64"),
        ),
    )


def page_dimensions(page: ColumnOrName) -> Column:
    """Page size, or NULL when the service gave none."""
    size = col(page)["dimensions"]
    whole = F.struct(*[size[name].try_cast("int").alias(name) for name in DIMENSIONS.names])
    return F.when(size.isNotNull(), whole)
