"""Text comparison rules: case and trailing blanks do not matter, NULL is never true."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key(value: Column | str) -> Column:
    """Comparable form of a text key."""
    return F.lower(F.rtrim(_col(value)))


def spread_key(value: Column | str, row_id: Column | str) -> Column:
    """Comparable form of a key where a missing one becomes a value that matches nothing.

    Missing keys would all be sent to one partition of a join; here each goes its own way.
    """
    return F.coalesce(key(value), F.concat(F.lit("\x00"), _col(row_id)))


def same(left: Column | str, right: Column | str) -> Column:
    """Equality that ignores case and trailing blanks."""
    return key(left) == key(right)


def is_blank(value: Column | str) -> Column:
    """NULL, empty, only blanks, or the text `null`."""
    return F.coalesce(key(value), F.lit("")).isin("", "null")


def flag(condition: Column) -> Column:
    """A rule flag: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def real_value(value: Column | str) -> Column:
    """The value to store: the text `null` that stands for a JSON null becomes NULL."""
    return F.when(key(value) != "null", _col(value))


def short(value: Column, width: int | None = None) -> Column:
    """Text form of a value, cut at `width` characters where one is given."""
    text = value.cast("string")
    return text if width is None else F.substring(text, 1, width)


def fill(template: Column, **values: Column) -> Column:
    """Fill `[name]` places of a message; a NULL value leaves its place as it is."""
    for name, value in values.items():
        place = F.lit(f"[{name}]")
        template = F.replace(template, place, F.coalesce(value.cast("string"), place))
    return template


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
