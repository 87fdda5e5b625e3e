"""Page text and previews.

Preview lengths count UTF-16 units, of which a character beyond the basic
plane takes two. One that is cut in half shows as the replacement character.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.columns import ColumnOrName, col

CUT_MARK = "..."

_UTF16 = "UTF-16BE"
_BEYOND_BASIC_PLANE = r"[\x{10000}-\x{10FFFF}]"
_REPLACEMENT = "�"


def page_text(markdown: ColumnOrName) -> Column:
    return F.coalesce(col(markdown), F.lit(""))


def first_units(text: ColumnOrName, length: int) -> Column:
    """The first ``length`` UTF-16 units; only texts that need it are re-encoded."""
    prefix = F.substring(col(text), 1, length)
    units = F.substring(F.encode(prefix, _UTF16), 1, 2 * length)
    # The last unit opens a pair whose other half is cut off.
    halved = F.hex(F.substring(units, 2 * length - 1, 1)).between("D8", "DB")
    whole = F.decode(F.when(halved, F.substring(units, 1, 2 * length - 2)).otherwise(units), _UTF16)
    cut = F.concat(whole, F.when(halved, F.lit(_REPLACEMENT)).otherwise(F.lit("")))
    return F.when(prefix.rlike(_BEYOND_BASIC_PLANE), cut).otherwise(prefix)


def preview_fixed(text: ColumnOrName, length: int = 200) -> Column:
    """First ``length`` units, always followed by the cut mark."""
    return F.concat(first_units(text, length), F.lit(CUT_MARK))


def preview_if_longer(text: ColumnOrName, length: int = 500) -> Column:
    """The text itself unless it is longer than ``length`` units."""
    text = col(text)
    # Between half the length and the length, pairs decide.
    longer = F.when(F.length(text) > length, F.lit(True)).when(
        F.length(text) > length // 2, F.octet_length(F.encode(text, _UTF16)) > 2 * length
    )
    return F.when(longer, preview_fixed(text, length)).otherwise(text)
