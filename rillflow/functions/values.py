"""Small value helpers shared by catalog and quality operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Topic names are 1 to 99 characters and hold no slash of either kind.
MAX_TOPIC_LENGTH = 99
TOPIC_FORBIDDEN = r"[/\\]"


def value_or(value: Column, default: Column | str) -> Column:
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def value_if_all_set(keys: Sequence[Column], value: Column, default: Column) -> Column:
    """``value`` when every key column is set, else ``default``."""
    if not keys:
        return value
    return F.when(reduce(lambda a, b: a & b, [k.isNotNull() for k in keys]), value).otherwise(default)


def is_valid_topic(topic: Column) -> Column:
    ok = F.char_length(topic).between(1, MAX_TOPIC_LENGTH) & ~topic.rlike(TOPIC_FORBIDDEN)
    return F.coalesce(ok, F.lit(False))


def is_set_and_not_empty(value: Column, is_collection: bool = False) -> Column:
    """Set, and for arrays and maps also not empty. Text passes even when empty."""
    if is_collection:
        return F.coalesce(F.size(value) > 0, F.lit(False))
    return value.isNotNull()


def require_set(value: Column, message: str) -> Column:
    """``value`` itself; the query fails with ``message`` where it is NULL."""
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(message)))
