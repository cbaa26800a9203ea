"""JSON text and bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def to_json_bytes(record: Column) -> Column:
    return F.encode(F.to_json(record), "UTF-8")


def from_json_text(text: Column, schema: DataType | str) -> Column:
    """Decode JSON text; malformed text gives NULL members."""
    return F.from_json(text, schema)


def from_json_bytes(value: Column, schema: DataType | str) -> Column:
    return F.from_json(F.make_valid_utf8(value.cast("string")), schema)
