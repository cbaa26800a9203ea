"""Text messages: decode, split to fields, pick fields, join them again.

Every expression here stays inside whole-stage code generation, so parsing runs
as one stage with the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_text(value: Column) -> Column:
    """UTF-8 bytes to text; malformed bytes become U+FFFD instead of failing the task."""
    return F.make_valid_utf8(value.cast("string"))


def encode_text(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def split_pattern(separator: Column) -> Column:
    """The regular expression that matches one separator character literally.

    Punctuation gets a backslash: a one- or two-character literal pattern takes
    the JVM's split fast path and never compiles a regular expression.
    """
    return F.when(separator.rlike(r"^\p{Punct}$"), F.concat(F.lit("\\"), separator)).otherwise(separator)


def split_fields(text: Column, separator_pattern: Column | str) -> Column:
    """Fields of a line. Runs of the separator count once, so no field is empty."""
    return F.array_remove(F.split(text, separator_pattern), "")


def field_at(fields: Column, index: Column | int) -> Column:
    """One field as an array; empty when the index is past the end."""
    index = index if isinstance(index, Column) else F.lit(index)
    return F.slice(fields, F.least(index, F.size(fields)) + 1, F.lit(1))


def field_range(fields: Column, start: Column | int, end: Column | int) -> Column:
    """Fields ``start`` to ``end``, with the end left out.

    ``end == -1`` reads to the last field, an end past the last field is cut to
    it, an end at or before the start gives one field, and a start past the last
    field gives none.
    """
    start = start if isinstance(start, Column) else F.lit(start)
    end = end if isinstance(end, Column) else F.lit(end)
    count = F.size(fields)
    length = F.when((end == -1) | (end > count), count - start).otherwise(F.greatest(end - start, F.lit(1)))
    return F.slice(fields, F.least(start, count) + 1, F.greatest(length, F.lit(0)))


def join_fields(fields: Column, separator: Column | str) -> Column:
    """Fields back to one line, with the separator they were split on."""
    separator = separator if isinstance(separator, Column) else F.lit(separator)
    # array_join takes a literal delimiter only through the SQL function.
    return F.call_function("array_join", fields, separator)
