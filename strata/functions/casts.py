"""Lenient typed casts for JSON leaves (SCL-1..5, decisions D1 and D3).

The raw schemas declare scalar leaves of traffic, weather and flights as text,
so a payload that spells a number as ``"24"`` or ``24.0`` still lands. These
helpers turn that text into typed values with the null-on-failure behaviour the
payload curators were written against, while the session stays ANSI-on: a bad
value becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal text such as "123.7" or "24." - the only fractional spelling an
# integer cast accepts (by truncation). Exponent forms stay NULL for integers.
DECIMAL_TEXT = r"^\s*[+-]?[0-9]+\.[0-9]*\s*$"

_INTEGRAL = {"int", "integer", "bigint", "long", "smallint", "short", "tinyint", "byte"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_cast(c: Column | str, data_type: str) -> Column:
    """SCL-1: cast a JSON leaf to ``data_type``; unparseable or overflowing -> NULL.

    Integral targets accept plain decimal text by truncating toward zero
    (``"123.7"`` -> 123); values outside the target range give NULL (D1).
    """
    text = _col(c).cast("string")
    target = data_type.lower()
    if target in ("string", "varchar"):
        return text
    if target in _INTEGRAL:
        # The direct cast never accepts decimal text, so the pattern test only
        # runs for values that failed it (rare in clean data).
        via_double = text.try_cast("double").try_cast(target)
        return F.coalesce(text.try_cast(target), F.when(text.rlike(DECIMAL_TEXT), via_double))
    return text.try_cast(target)


def parse_timestamp(c: Column | str) -> Column:
    """SCL-2: ISO-8601 text to TIMESTAMP in the session zone, NULL when unparseable."""
    return F.try_to_timestamp(_col(c).cast("string"))


def parse_date(c: Column | str) -> Column:
    """SCL-3: ISO date (or timestamp) text to DATE, NULL when unparseable."""
    return _col(c).cast("string").try_cast("date")


def trimmed_text(c: Column | str) -> Column:
    """SCL-4: strip surrounding blanks; blank text becomes '' (not NULL)."""
    return F.trim(_col(c).cast("string"))


def slot(array_col: Column | str, index: int) -> Column:
    """SCL-5: element ``index`` (0-based) of an array, NULL when out of range."""
    return F.get(_col(array_col), index)


def array_length(array_col: Column | str) -> Column:
    """Length of an array, NULL for a NULL array - whatever the session's
    ANSI setting (without ANSI, ``size(NULL)`` is -1)."""
    a = _col(array_col)
    return F.when(a.isNotNull(), F.size(a))
