"""Text to typed values; anything outside the accepted text form becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from salesmart.schema import PRICE

# Fixed patterns: the number and timestamp texts the warehouse accepts.
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)\s*$"
TIMESTAMP_TEXT = r"^\s*(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?\s*$"


def to_smallint(text: Column) -> Column:
    return F.when(text.rlike(INTEGER_TEXT), F.trim(text).try_cast("smallint"))


def to_decimal(text: Column) -> Column:
    """decimal(10,2), rounded half up; exponents, thousands separators and currency signs are not numbers."""
    return F.when(text.rlike(DECIMAL_TEXT), F.trim(text).try_cast(PRICE))


def to_ts(text: Column) -> Column:
    """ISO date or date-time only: a bare year or time of day would otherwise parse as some other day."""
    return F.when(text.rlike(TIMESTAMP_TEXT), F.trim(text).try_cast("timestamp_ntz"))


def date_key(moment: Column) -> Column:
    """yyyymmdd as an integer; pass a column, since an expression would be worked out three times."""
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.day(moment)).cast("int")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")
