"""Event time of a message, in epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ISO-8601 shapes read as event time besides plain digits.
EXTENDED = (
    r"^[0-9]{4}-[0-9]{2}(-[0-9]{2}([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?)?$"
)
HOUR_ONLY = r"^([^T ]*[T ][0-9]{2})(Z|[+-].*)?$"
BASIC_DATE_TIME = (
    r"^([0-9]{4})([0-9]{2})([0-9]{2})T([0-9]{2})([0-9]{2})([0-9]{2})(\.[0-9]{3})?(Z|[+-][0-9]{4})$"
)
ORDINAL_DATE = r"^[0-9]{4}-[0-9]{3}$"
WEEK_DATE = r"^[0-9]{4}-W[0-9]{2}(-[1-7])?$"

DIGITS = r"\A[0-9]+\z"

# Milliseconds a Spark timestamp (64-bit microseconds) can hold.
MAX_MILLIS = 9_223_372_036_854_775


def is_digits(text: Column) -> Column:
    return text.rlike(DIGITS)


def iso_to_millis(text: Column) -> Column:
    """Milliseconds of an ISO-8601 text, NULL when it is not one. No zone means UTC."""
    extended = F.regexp_replace(text, BASIC_DATE_TIME, "$1-$2-$3T$4:$5:$6$7$8")
    extended = F.regexp_replace(extended, HOUR_ONLY, "$1:00$2")
    extended = F.when(text.rlike(f"{EXTENDED}|{BASIC_DATE_TIME}"), extended.try_cast("timestamp"))
    # Week 1 is the week of January 4th.
    week_start = F.date_trunc("week", F.concat(F.substring(text, 1, 4), F.lit("-01-04")).try_cast("timestamp"))
    week = F.substring(text, 7, 2).try_cast("int")
    day = F.coalesce(F.substring(text, 10, 1).try_cast("int"), F.lit(1))
    week_date = F.when(week.between(1, 53), F.timestamp_add("DAY", week * 7 + day - 8, week_start))
    parsed = (
        F.when(text.rlike(WEEK_DATE), week_date)
        .when(text.rlike(ORDINAL_DATE), F.try_to_timestamp(text, F.lit("yyyy-DDD")))
        .otherwise(extended)
    )
    return F.unix_millis(parsed)


def to_millis(text: Column) -> Column:
    """Digits are milliseconds already; anything else is read as ISO-8601."""
    return F.when(is_digits(text), text.try_cast("bigint")).otherwise(iso_to_millis(text))


def now_millis() -> Column:
    """Processing time: fixed per query or per micro-batch."""
    return F.unix_millis(F.current_timestamp())


def event_millis(field: Column, index: Column | int, scale: Column | int = 1) -> Column:
    """Event time from the text of the time field.

    ``scale`` is 1 for millisecond fields and 1000 for second fields; it applies
    to parsed ISO texts as well. A negative ``index`` means processing time. NULL
    marks a missing or unreadable field.
    """
    index = index if isinstance(index, Column) else F.lit(index)
    scale = (scale if isinstance(scale, Column) else F.lit(scale)).cast("bigint")
    return F.when(index < 0, now_millis()).otherwise(F.try_multiply(to_millis(field), scale))


def millis_to_timestamp(millis: Column) -> Column:
    """Timestamp of epoch milliseconds, NULL outside the range a timestamp holds."""
    return F.when(millis.between(-MAX_MILLIS, MAX_MILLIS), F.timestamp_millis(millis))
