"""Counters, rates and load statistics as aggregates.

Every metric pre-aggregates per task, so a hot topic shuffles only its partial
counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import TimerValues

from rillflow.functions.keys import minute_key

# Averaging windows of the message meter, in minutes.
RATE_WINDOWS = {"one_minute_rate": 1, "five_minute_rate": 5}

# The state store that keyed state of any kind needs.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

# Minutes per block of the moving rates. What lies before the previous block weighs
# at most exp(-200 / 5), below half a unit in the last place of a double, so a
# rate needs its own block and the one before.
RATE_BLOCK_MINUTES = 200


def topic_hour_counts(rows: DataFrame) -> DataFrame:
    """Messages per topic and hour; ``rows`` hold ``topic`` and ``hour``."""
    return rows.groupBy("topic", "hour").agg(F.count(F.lit(1)).alias("messages"))


def minute_counters(rows: DataFrame, phase: str, ts: str = "ts", increment: Column | None = None) -> DataFrame:
    """Counter per phase, topic and minute; each row adds ``increment`` (default 1)."""
    increment = F.lit(1) if increment is None else increment
    keyed = rows.withColumn("minute", minute_key(F.col(ts)))
    return (
        keyed.groupBy("topic", "minute")
        .agg(F.sum(increment.cast("bigint")).alias("n"))
        .select(F.lit(phase).alias("phase"), "topic", "minute", "n")
    )


def counters_of(counters: DataFrame, phase: str, topic: str) -> DataFrame:
    """Counters of one phase and topic."""
    return counters.filter((F.col("phase") == phase) & (F.col("topic") == topic))


def windowed_counters(rows: DataFrame, phase: str, ts: str = "ts", watermark: str = "1 hour") -> DataFrame:
    """The same counters for a stream: late rows count until the watermark passes."""
    counted = (
        rows.withWatermark(ts, watermark)
        .groupBy("topic", F.window(ts, "1 minute").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(F.lit(phase).alias("phase"), "topic", minute_key(F.col("w.start")).alias("minute"), "n")


def load_stats(runs: DataFrame, elapsed_ms: str = "elapsed_ms", messages: str = "messages", by: list[str] | None = None) -> DataFrame:
    """Count, mean, max and min of elapsed time, and messages per second.

    The rate is all messages over the mean elapsed seconds, as runs overlap in
    time. Without runs the mean is 0.
    """
    total = F.coalesce(F.sum(messages), F.lit(0)).cast("bigint")
    mean = F.coalesce(F.avg(elapsed_ms), F.lit(0.0))
    return runs.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("runs"),
        total.alias("messages"),
        mean.alias("mean_ms"),
        F.max(elapsed_ms).alias("max_ms"),
        F.min(elapsed_ms).alias("min_ms"),
        F.floor(F.when(mean > 0, total * 1000 / mean)).alias("rate_per_sec"),
    )


def message_rates(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """Message meter per topic and minute: running count, mean rate since the
    first minute, and one- and five-minute moving rates, all per second.

    A moving rate weighs each minute by ``alpha * exp(-age / window)``; the first
    minute of a topic seeds it with weight ``exp(-age / window)``. Rows are first
    counted per minute. Running sums are taken within blocks of minutes, so a
    topic's history is spread over tasks, and blocks are linked by their totals.
    """
    weights = {name: f"_w_{name}" for name in RATE_WINDOWS}
    minute = F.floor(F.unix_seconds(ts) / 60).alias("minute_index")
    per_minute = rows.groupBy("topic", minute).agg(F.count(F.lit(1)).alias("n"))
    block = F.floor(F.col("minute_index") / RATE_BLOCK_MINUTES)
    per_minute = per_minute.withColumn("block", block)
    offset = (F.col("minute_index") - F.col("block") * RATE_BLOCK_MINUTES).cast("double")
    per_minute = per_minute.withColumns({
        "offset": offset,
        **{weights[name]: F.col("n") * F.exp(offset / minutes) for name, minutes in RATE_WINDOWS.items()},
    })

    summed = ["n", *weights.values()]
    totals = per_minute.groupBy("topic", "block").agg(
        F.min("minute_index").alias("first_index"),
        F.min_by("n", "minute_index").alias("first_n"),
        *[F.sum(c).alias(c) for c in summed],
    )
    by_block = Window.partitionBy("topic").orderBy("block")
    so_far = by_block.rowsBetween(Window.unboundedPreceding, 0)
    adjacent = F.lag("block").over(by_block) == F.col("block") - 1
    linked = totals.select(
        "topic",
        "block",
        (F.sum("n").over(so_far) - F.col("n")).alias("n_before"),
        F.first("first_index").over(so_far).alias("first_index"),
        F.first("first_n").over(so_far).alias("first_n"),
        *[F.when(adjacent, F.lag(w).over(by_block)).otherwise(F.lit(0.0)).alias(f"{w}_before") for w in weights.values()],
    )

    running = Window.partitionBy("topic", "block").orderBy("minute_index").rowsBetween(Window.unboundedPreceding, 0)
    counted = per_minute.withColumns({f"{c}_run": F.sum(c).over(running) for c in summed}).join(linked, ["topic", "block"])
    age = (F.col("minute_index") - F.col("first_index")).cast("double")
    count = F.col("n_before") + F.col("n_run")
    rates = []
    for name, minutes in RATE_WINDOWS.items():
        alpha = 1 - math.exp(-1 / minutes)
        carried = F.col(f"{weights[name]}_before") * math.exp(-RATE_BLOCK_MINUTES / minutes)
        recent = (F.col(f"{weights[name]}_run") + carried) * F.exp(-F.col("offset") / minutes)
        seed = F.col("first_n") * F.exp(-age / minutes)
        rates.append(((alpha * recent + (1 - alpha) * seed) / 60).alias(name))
    return counted.select(
        "topic", "minute_index", count.alias("count"), (count / ((age + 1) * 60)).alias("mean_rate"), *rates
    )


METER_SCHEMA = "topic string, minute_index bigint, count bigint, mean_rate double, " + ", ".join(f"{name} double" for name in RATE_WINDOWS)
_METER_STATE = "first bigint, last bigint, count bigint, " + ", ".join(f"{name} double" for name in RATE_WINDOWS)


class _Meter(StatefulProcessor):
    """A topic's meter, moved on by its closed minutes in their order; minutes without messages only let the rates fall."""

    def __init__(self, idle_ms: int | None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.meter = handle.getValueState("meter", _METER_STATE, self.idle_ms)

    def handleInputRows(self, key: tuple[str], rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        closed = pd.concat(list(rows)).sort_values("minute_index")
        first, last, count, *rates = self.meter.get() or (None, None, 0, *[0.0] * len(RATE_WINDOWS))
        told = []
        for minute, n in zip(closed["minute_index"].tolist(), closed["n"].tolist()):
            if first is None:
                first, rates = minute, [n / 60] * len(rates)
            else:
                rates = [old * math.exp((last - minute) / window) + (1 - math.exp(-1 / window)) * n / 60 for old, window in zip(rates, RATE_WINDOWS.values())]
            last, count = minute, count + n
            told.append((key[0], minute, count, count / ((minute - first + 1) * 60), *rates))
        self.meter.update((first, last, count, *rates))
        yield pd.DataFrame(told, columns=["topic", "minute_index", "count", "mean_rate", *RATE_WINDOWS])

    def close(self) -> None:
        pass


def streamed_rates(rows: DataFrame, ts: str = "ts", watermark: str = "1 hour", idle_ms: int | None = None) -> DataFrame:
    """``message_rates`` of a stream: each minute's values when the watermark has closed it.

    Minutes are counted by Spark's windows, so a hot topic sends a row a minute to
    its meter. The meter's state is one row per topic: its first and last minute,
    the count and the moving rates. Rows later than the watermark are not counted.
    With ``idle_ms`` a topic that is silent for so long is forgotten and starts
    anew; this is the clock's time. The query must be started with ``STATE_STORE``
    in its session's settings.
    """
    counted = rows.withWatermark(ts, watermark).groupBy("topic", F.window(ts, "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    minutes = counted.select("topic", F.floor(F.unix_seconds("w.start") / 60).alias("minute_index"), "n")
    clock = "None" if idle_ms is None else "ProcessingTime"
    return minutes.groupBy("topic").transformWithStateInPandas(_Meter(idle_ms), METER_SCHEMA, "append", clock)


def file_meters(files: DataFrame) -> DataFrame:
    """Files and bytes of a file listing (``path``, ``length``)."""
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def messages_per_file(lines: DataFrame) -> DataFrame:
    """Messages per file, for rows read from a file source."""
    return lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("messages"))


def replay_rates(rows: DataFrame, every: int = 100_000) -> DataFrame:
    """Messages per second for each block of ``every`` messages of a partition.

    Rows hold a broker's ``topic``, ``partition``, ``offset`` and ``timestamp``.
    """
    block = F.floor(F.col("offset") / every)
    seconds = F.unix_millis(F.max("timestamp")) - F.unix_millis(F.min("timestamp"))
    return rows.groupBy("topic", "partition", block.alias("block")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.floor(F.when(seconds > 0, F.count(F.lit(1)) * 1000 / seconds)).alias("rate_per_sec"),
    )
