"""Keys and names: topic-hour keys, lake directories, partition specs, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date shapes used in keys, directories and partition specs.
HOUR_KEY_FORMAT = "yyyy-MM-dd-HH"
DAY_DIR_FORMAT = "yyyyMMdd"
HOUR_DIR_FORMAT = "yyyyMMddHH"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"
DATE_HOUR_LAYOUT = "datehour"
FILE_HOUR_PATTERN = r"-([0-9]{4}-[0-9]{2}-[0-9]{2}-[0-9]{2})"
FILE_TOPIC_PATTERN = r"(.+)-[0-9]+-[0-9]{2}-[0-9]{2}-[0-9]{2}"


def _format(ts: Column, pattern: str) -> Column:
    # Years past 9999 print with a plus sign, which the keys do not carry.
    return F.ltrim(F.date_format(ts, pattern), F.lit("+"))


def hour_key(ts: Column) -> Column:
    """``yyyy-MM-dd-HH`` of an event time."""
    return _format(ts, HOUR_KEY_FORMAT)


def topic_hour_key(topic: Column, ts: Column) -> Column:
    """``topic-yyyy-MM-dd-HH``; NULL when the topic or the time is missing."""
    return F.concat(topic, F.lit("-"), hour_key(ts))


def day_dir(ts: Column) -> Column:
    return _format(ts, DAY_DIR_FORMAT)


def hour_dir(ts: Column) -> Column:
    return _format(ts, HOUR_DIR_FORMAT)


def minute_key(ts: Column) -> Column:
    return _format(ts, MINUTE_KEY_FORMAT)


def zero_pad(number: Column) -> Column:
    """A number as text, with one leading zero below ten."""
    text = number.cast("string")
    return F.when(number < 10, F.concat(F.lit("0"), text)).otherwise(text)


def parse_hour_key(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(HOUR_KEY_FORMAT))


def _none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_hour(path: Column) -> Column:
    """The first ``yyyy-MM-dd-HH`` in a file name, or NULL."""
    return _none_if_empty(F.regexp_extract(base_name(path), FILE_HOUR_PATTERN, 1))


def file_topic(path: Column) -> Column:
    """What stands before the last ``-yyyy-MM-dd-HH`` of a file name, or NULL."""
    return _none_if_empty(F.regexp_extract(base_name(path), FILE_TOPIC_PATTERN, 1))


def strip_first_slash(path: Column) -> Column:
    return F.regexp_replace(path, r"\A/", "")


def strip_last_slash(path: Column) -> Column:
    return F.regexp_replace(path, r"/\z", "")


def lake_dir(base: Column, part: Column, date_format: Column, ts: Column) -> Column:
    """``base/part/date=yyyyMMdd`` with ``/hour=yyyyMMddHH`` for the hourly layout.

    Every other layout name, NULL included, is daily.
    """
    day = F.concat(strip_last_slash(base), F.lit("/"), strip_last_slash(strip_first_slash(part)), F.lit("/date="), day_dir(ts))
    hourly = F.coalesce(date_format == DATE_HOUR_LAYOUT, F.lit(False))
    return F.when(hourly, F.concat(day, F.lit("/hour="), hour_dir(ts))).otherwise(day)


def destination_path(base: Column, part: Column, date_format: Column, host: Column, file: Column) -> Column:
    """Where a finished file goes: its lake directory plus ``host-name``.

    NULL when the file name carries no hour or the partition name is missing;
    such files belong in quarantine.
    """
    directory = lake_dir(base, part, date_format, parse_hour_key(file_hour(file)))
    return F.concat(directory, F.lit("/"), host, F.lit("-"), base_name(file))


def partition_spec(hour_text: Column) -> Column:
    """``dt=yyyyMMdd,hr=yyyyMMddHH`` of an hour key."""
    ts = parse_hour_key(hour_text)
    return F.concat(F.lit("dt="), day_dir(ts), F.lit(",hr="), hour_dir(ts))


def table_name(topic: Column) -> Column:
    return F.translate(topic, "-", "_")


def jdbc_database(url: Column) -> Column:
    """Database name in a JDBC URL: the last path part up to its parameters."""
    return F.get(F.split(F.element_at(F.split(url, "/"), -1), "[?:;]"), F.lit(0))
