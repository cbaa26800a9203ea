"""Bad-input isolation: what cannot be used is set aside and counted, never lost."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.functions.keys import hour_key

# Fixed value: errors a topic may collect before it is flagged.
ERROR_THRESHOLD = 100


@dataclass(frozen=True)
class Split:
    good: DataFrame
    bad: DataFrame


def split_by_error(parsed: DataFrame) -> Split:
    """Rows without and with an ``error``."""
    return Split(parsed.filter(F.col("error").isNull()), parsed.filter(F.col("error").isNotNull()))


def with_hour_key(rows: DataFrame, ts: str = "ts") -> DataFrame:
    return rows.withColumn("hour", hour_key(F.col(ts)))


def keyed_rows(rows: DataFrame) -> DataFrame:
    """Rows that have a topic and an hour; the others cannot be filed by topic-hour."""
    return rows.filter(F.col("topic").isNotNull() & F.col("hour").isNotNull())


def errors_per_topic(parsed: DataFrame) -> DataFrame:
    bad = parsed.filter(F.col("error").isNotNull())
    return bad.groupBy("topic").agg(F.count(F.lit(1)).alias("errors"))


def flagged_topics(parsed: DataFrame, threshold: int = ERROR_THRESHOLD) -> DataFrame:
    """Topics with more errors than ``threshold``.

    Counting starts anew each time a topic is flagged, so ``times_flagged`` is
    how often the count passed the threshold and ``errors_left`` what the
    counter holds after the last time.
    """
    step = threshold + 1
    counted = errors_per_topic(parsed).filter(F.col("errors") > threshold)
    return counted.select(
        "topic",
        "errors",
        F.floor(F.col("errors") / step).alias("times_flagged"),
        (F.col("errors") % step).alias("errors_left"),
    )


ERROR_TOTALS_SCHEMA = "topic string, errors bigint, times_flagged bigint"


def add_errors(totals: DataFrame, batch_errors: DataFrame, threshold: int = ERROR_THRESHOLD) -> DataFrame:
    """Error totals per topic after another batch, from those before it.

    ``newly_flagged`` marks topics whose count passed the threshold in this batch.
    """
    before = totals.select("topic", "errors", "times_flagged")
    now = batch_errors.select("topic", "errors", F.lit(0).cast("bigint").alias("times_flagged"))
    summed = before.unionByName(now).groupBy("topic").agg(F.sum("errors").alias("errors"), F.max("times_flagged").alias("_before"))
    times = F.floor(F.col("errors") / (threshold + 1))
    return summed.select("topic", "errors", times.alias("times_flagged"), (times > F.col("_before")).alias("newly_flagged"))
