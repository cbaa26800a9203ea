"""Generated messages: a time and 100 random capital letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Letters per message and the fields of a generated record.
MESSAGE_LETTERS = 100
RECORD_SCHEMA = '{"type": "record", "name": "Generated", "namespace": "rillflow", "fields": [{"name": "ts", "type": "long"}, {"name": "data", "type": "string"}]}'


def random_letters(length: int = MESSAGE_LETTERS) -> Column:
    return F.concat_ws("", *[F.char((F.rand() * 26).cast("int") + 65) for _ in range(length)])


def generate_messages(spark: SparkSession, threads: int, per_thread: int) -> DataFrame:
    """``ts, data`` rows, ``per_thread`` in each of ``threads`` partitions."""
    rows = spark.range(0, threads * per_thread, 1, threads)
    return rows.select(F.unix_millis(F.current_timestamp()).alias("ts"), random_letters().alias("data"))


def stream_generated(spark: SparkSession, rows_per_second: int) -> DataFrame:
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return ticks.select(F.unix_millis("timestamp").alias("ts"), random_letters().alias("data"))
