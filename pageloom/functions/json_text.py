"""Indented JSON text of a document's metadata.

Spark's own pretty printer lays arrays and separators out differently and
cannot tell an absent key from a null one, so the text is put together here
from built-in string functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.columns import ColumnOrName, col

INDENT = "  "


def quoted(text: Column) -> Column:
    """A JSON string literal; NULL stays NULL."""
    as_array = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(as_array, F.lit(2), F.length(as_array) - 2))


# A string, an empty container, one sign, or a number, boolean or null. The
# possessive quantifiers keep long strings from taking stack.
_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|\{\}|\[\]|[\[\]{}:,]|[^\[\]{}:,"]+'


def number_text(text: Column) -> Column:
    """A JSON number as JavaScript prints it: no needless fraction or exponent."""
    size = F.abs(text.try_cast("double"))
    exponent = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), "E-", "e-"), r"E(\d)", r"e+$1")

    def plain(kind: str) -> Column:
        return F.regexp_replace(text.try_cast(kind).cast("string"), r"\.?0+$", "")

    return (
        F.when(~text.contains("E"), F.regexp_replace(F.regexp_replace(text, r"\.0+$", ""), "^-0$", "0"))
        .when((size >= 1e21) | (size < 1e-6), exponent)
        .when(size >= 1, plain("decimal(38,15)"))
        .otherwise(plain("decimal(38,30)"))
    )


def typed_text(value: Column, depth: int) -> Column:
    """JSON text of a VARIANT whose key is a member at a depth; NULL stays NULL.

    Lists and objects are laid out token by token: the text grows with each
    one, so the cost of a single value is quadratic in its size. Keys of
    objects are in sorted order, as a VARIANT keeps them.
    """
    text = F.to_json(value)
    is_number = F.lit(r"^-?[0-9]")
    line = lambda d: F.concat(F.lit("\n"), F.repeat(F.lit(INDENT), d))

    def step(done: Column, token: Column) -> Column:
        d, t = done["d"], done["t"]
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        scalar = F.when(F.regexp(token, is_number), number_text(token)).otherwise(token)
        grown = (
            F.when(opens, F.concat(t, token, line(d + 1)))
            .when(closes, F.concat(t, line(d - 1), token))
            .when(token == ",", F.concat(t, token, line(d)))
            .when(token == ":", F.concat(t, F.lit(": ")))
            .otherwise(F.concat(t, scalar))
        )
        deeper = F.when(opens, d + 1).when(closes, d - 1).otherwise(d)
        return F.struct(deeper.alias("d"), grown.alias("t"))

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    start = F.struct(F.lit(depth + 1).alias("d"), F.lit("").alias("t"))
    laid_out = F.aggregate(tokens, start, step, lambda done: done["t"])
    return F.when(F.substring(text, 1, 1).isin("{", "["), laid_out).otherwise(
        F.when(F.regexp(text, is_number), number_text(text)).otherwise(text)
    )


def _value(text: Column) -> Column:
    return F.coalesce(text, F.lit("null"))


def _block(members: Column, opening: str, closing: str, depth: int, filled: Column | None = None) -> Column:
    """Members one per line between brackets; NULL members are left out.

    ``filled`` tells whether there is a member at all. It is asked for instead
    of looking at ``members``, which would evaluate nested text twice per level.
    """
    pad = "\n" + INDENT * (depth + 1)
    end = "\n" + INDENT * depth + closing
    text = F.concat(F.lit(opening + pad), F.array_join(members, "," + pad), F.lit(end))
    return text if filled is None else F.when(filled, text).otherwise(F.lit(opening + closing))


def _member(key: str, text: Column) -> Column:
    """``"key": text``; NULL text means the key is absent."""
    return F.concat(F.lit(f'"{key}": '), text)


def _object(members: list[Column], depth: int, filled: Column | None = None) -> Column:
    return _block(F.array(*members), "{", "}", depth, filled)


def _map_members(entries: Column, typed: bool, depth: int) -> Column:
    value = (lambda v: typed_text(v, depth)) if typed else quoted
    return F.transform(
        F.map_entries(entries),
        lambda entry: F.concat(quoted(entry["key"]), F.lit(": "), _value(value(entry["value"]))),
    )


def _map(entries: Column, typed: bool, depth: int) -> Column:
    text = _block(_map_members(entries, typed, depth), "{", "}", depth, F.size(entries) > 0)
    return F.when(entries.isNotNull(), text)


def _number(value: Column) -> Column:
    return value.cast("string")


def _any_set(struct: Column, names: tuple[str, ...]) -> Column:
    found = struct[names[0]].isNotNull()
    for name in names[1:]:
        found = found | struct[name].isNotNull()
    return found


def _loc(loc: Column, depth: int) -> Column:
    body = _object([_member("pageNumber", _number(loc["pageNumber"]))], depth, loc["pageNumber"].isNotNull())
    return F.when(loc.isNotNull(), body)


def _pdf(pdf: Column, has_info: Column, typed: bool, depth: int) -> Column:
    def nullable(text: Column) -> Column:
        # Read info keeps its nulls; without it the keys are absent.
        return F.when(has_info, _value(text)).otherwise(text)

    body = _object(
        [
            _member("version", nullable(quoted(pdf["version"]))),
            _member("info", nullable(_map(pdf["info"], typed, depth + 1))),
            _member("metadata", nullable(_map(pdf["metadata"], typed, depth + 1))),
            _member("totalPages", nullable(_number(pdf["totalPages"]))),
            _member("loc", _loc(pdf["loc"], depth + 1)),
        ],
        depth,
        _any_set(pdf, ("version", "info", "metadata", "totalPages", "loc")),
    )
    return F.when(pdf.isNotNull(), body)


def _region(region: Column, depth: int) -> Column:
    corners = ("top_left_x", "top_left_y", "bottom_right_x", "bottom_right_y")
    return _object(
        [
            _member("id", quoted(region["id"])),
            *[_member(name, _number(region[name])) for name in corners],
            _member("image_base64", quoted(region["image_base64"])),
        ],
        depth,
    )


def _regions(images: Column, depth: int) -> Column:
    members = F.transform(images, lambda region: _region(region, depth + 1))
    return F.when(images.isNotNull(), _block(members, "[", "]", depth, F.size(images) > 0))


def _dimensions(dimensions: Column, images: Column, depth: int) -> Column:
    names = ("dpi", "height", "width")
    members = [_member(name, _number(dimensions[name])) for name in names]
    body = _object(members, depth, _any_set(dimensions, names))
    text = F.when(dimensions.isNotNull(), body).otherwise(F.lit("null"))
    return F.when(images.isNotNull(), text)


def metadata_json(metadata: ColumnOrName, typed_extra: bool = False, typed_pdf: bool = False) -> Column:
    """Metadata as JSON with two-space indentation and keys in merge order.

    ``typed_extra`` and ``typed_pdf`` say that the caller's keys, or those of
    the PDF, hold VARIANT values.
    """
    meta = col(metadata)
    pdf, images = meta["pdf"], meta["images"]
    has_info = F.coalesce(pdf["totalPages"].isNotNull(), F.lit(False))
    pdf_member = _member("pdf", _pdf(pdf, has_info, typed_pdf, 1))
    members = F.concat(
        F.array(_member("source", quoted(meta["source"]))),
        F.coalesce(_map_members(meta["extra"], typed_extra, 0), F.array().cast("array<string>")),
        F.array(
            F.when(has_info, pdf_member),
            _member("images", _regions(images, 1)),
            _member("dimensions", _dimensions(meta["dimensions"], images, 1)),
            F.when(~has_info, pdf_member),
            _member("loc", _loc(meta["loc"], 1)),
        ),
    )
    return _block(members, "{", "}", 0)
