"""Value checks: each returns a non-NULL flag that is true when the value fails."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.constants import DATE_FORMATS
from leadloom.functions.text import flag

_DIGITS = r"\A[0-9]+\z"
_NUMBER = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\z"


def bad_id_number(value: Column) -> Column:
    """Anything but digits between optional blanks; a missing number fails too."""
    return ~flag(F.trim(value).rlike(_DIGITS))


def bad_date(value: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """No accepted notation reads the value; missing and blank values pass."""
    text = F.trim(value)
    unreadable = reduce(lambda a, b: a & b, [F.try_to_date(text, f).isNull() for f in formats])
    return flag((text != "") & unreadable)


def bad_number(value: Column) -> Column:
    """Not a plain number of at most 18 whole digits; blank fails, missing passes."""
    text = F.trim(value)
    readable = text.rlike(_NUMBER) & text.try_cast("decimal(18,0)").isNotNull()
    return flag(value.isNotNull() & ~readable)


def too_long(value: Column, limit: Column) -> Column:
    """Longer than the limit, trailing blanks not counted; no limit or no value passes."""
    return flag(F.length(F.rtrim(value)) > limit)
