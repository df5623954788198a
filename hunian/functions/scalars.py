"""Text, number, JSON and map expressions. None of them raises on bad input.

``try_cast`` from text to a number works by a caught exception, which costs far
more than a search. So text reaches it only after a pattern has accepted it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What Python's ``str.strip`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_INTEGRAL = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"
_FRACTIONAL = (
    r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?[dDfF]?|(?i:nan|inf|infinity))\s*$"
)

# Price units and their worth.
PRICE_UNITS = (("Miliar", 1_000_000_000), ("Juta", 1_000_000))


def trim_text(text: Column) -> Column:
    """Strip white space of every kind, tabs, newlines and no-break spaces too."""
    return F.trim(text, F.lit(WHITESPACE))


def digits_only(text: Column) -> Column:
    """All digits of ``text`` read as one number; null if there are none."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def price(text: Column, allow_whole: bool = False) -> Column:
    """``Rp 1,5 Miliar`` -> 1500000000, exact through decimals.

    A number without a decimal part counts only with ``allow_whole``. The larger
    unit wins in a text with both.
    """
    number = r"\d+(?:,\d+)?" if allow_whole else r"\d+,\d+"
    result = F.lit(None).cast("bigint")
    for unit, worth in reversed(PRICE_UNITS):
        amount = F.regexp_extract(text, rf"Rp ({number}) {unit}", 1)
        value = F.replace(amount, F.lit(","), F.lit(".")).try_cast("decimal(18,6)") * F.lit(worth)
        result = F.when(amount != "", value.try_cast("bigint")).otherwise(result)
    return result


def to_int(text: Column) -> Column:
    """Integer cast that truncates ``3.7`` to 3 and gives null for anything else odd."""
    return F.nullif(F.regexp_extract(text, _INTEGRAL, 1), F.lit("")).try_cast("int")


def typed(text: Column, to: T.DataType) -> Column:
    """Cast raw text to a clean type, null on bad input."""
    if isinstance(to, T.StringType):
        return text.cast(to)
    if isinstance(to, T.IntegerType):
        return to_int(text)
    if isinstance(to, T.FloatType):
        return F.when(text.rlike(_FRACTIONAL), text.try_cast(to))
    return text.try_cast(to)


def part(text: Column, separator: str, index: int) -> Column:
    """The ``index``-th piece of a split, null when there are too few."""
    return F.get(F.split(text, _literal(separator)), F.lit(index))


def first_part(text: Column, separator: str = ",") -> Column:
    return trim_text(part(text, separator, 0))


def last_part(text: Column, separator: str = ",") -> Column:
    """The trimmed last piece, only when there is more than one."""
    pieces = F.split(text, _literal(separator))
    return F.when(F.size(pieces) > 1, trim_text(F.element_at(pieces, -1)))


def update_date(text: Column, by: str = "oleh") -> Column:
    """Second blank-separated token of what stands before ``by``."""
    return part(part(text, by, 0), " ", 1)


def update_agent(text: Column, by: str = "oleh") -> Column:
    """Trimmed piece between the first and the second ``by``."""
    return trim_text(part(text, by, 1))


def absolute_link(base: str, href: Column) -> Column:
    return F.concat(F.lit(base), href)


def load_time(now: datetime | None = None) -> Column:
    """The batch's load time: one value per query, or the given one."""
    return F.current_timestamp() if now is None else F.lit(now)


def iso_text(moment: Column) -> Column:
    """ISO-8601 text of a timestamp, micros kept."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def json_int(document: Column, path: str) -> Column:
    return to_int(F.get_json_object(document, path))


def json_size(document: Column, path: str) -> Column:
    """Number of elements of a JSON array, null if there is no array."""
    return F.json_array_length(F.get_json_object(document, path))


def advance_pages(provinces: Column, current_page: Column) -> Column:
    """Move every province standing at ``current_page`` one page on."""
    return F.transform_values(
        provinces, lambda _, page: F.when(page == current_page, page + 1).otherwise(page)
    )


def _literal(separator: str) -> str:
    return rf"\Q{separator}\E"
