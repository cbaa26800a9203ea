"""The date-partitioned lake: ``base/part/date=yyyyMMdd[/hour=yyyyMMddHH]``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions.keys import DATE_HOUR_LAYOUT, day_dir, hour_dir
from rillflow.sinks.landing import gather


def layout_columns(date_format: str | None) -> tuple[str, ...]:
    return ("date", "hour") if date_format == DATE_HOUR_LAYOUT else ("date",)


def with_layout(rows: DataFrame, date_format: str | None, ts: str = "ts") -> DataFrame:
    """Adds the directory columns of a layout from the event time."""
    columns = {"date": day_dir(F.col(ts)), "hour": hour_dir(F.col(ts))}
    return rows.withColumns({c: columns[c] for c in layout_columns(date_format)})


def topic_root(base: str, part: str) -> str:
    return f"{base.removesuffix('/')}/{part.removeprefix('/').removesuffix('/')}"


def write_lake(rows: DataFrame, base: str, part: str, date_format: str | None, fmt: str = "parquet", mode: str = "append", replace_touched: bool = False, writers: int | None = None, **options: str) -> None:
    """Rows that carry the layout's directory columns, written below ``base/part``.

    ``replace_touched`` overwrites exactly the directories that get rows and
    leaves every other one alone, so the same write may be run again.
    """
    keys = layout_columns(date_format)
    writer = gather(rows, keys, writers).write.partitionBy(*keys).options(**options)
    if replace_touched:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.format(fmt).save(topic_root(base, part))


def read_lake(spark: SparkSession, base: str, part: str, date_format: str | None, schema: str, fmt: str = "parquet") -> DataFrame:
    """A topic's lake rows, with the directory columns as text. Filters on them prune directories."""
    keys = ", ".join(f"{c} string" for c in layout_columns(date_format))
    return spark.read.format(fmt).schema(f"{schema}, {keys}").load(topic_root(base, part))


def write_quarantine(bad: DataFrame, quarantine: str, part: str, date_format: str | None = DATE_HOUR_LAYOUT, received: str = "received", mode: str = "append") -> None:
    """Unusable rows with their bytes and error, in the lake layout below the
    quarantine folder. They are filed by ``received`` time, having no event time."""
    rows = with_layout(bad, date_format, received)
    write_lake(rows.drop(received), quarantine, part, date_format, mode=mode)
