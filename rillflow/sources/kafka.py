"""Messages from a Kafka broker, streamed or replayed. Needs Spark's Kafka package."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Fixed value: milliseconds between micro-batches.
BATCH_MILLIS = 500


def has_kafka_package(spark: SparkSession) -> bool:
    loader = spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    try:
        loader.loadClass("org.apache.spark.sql.kafka010.KafkaSourceProvider")
    except Exception:
        return False
    return True


def _require(spark: SparkSession) -> None:
    if not has_kafka_package(spark):
        raise RuntimeError("start the session with the spark-sql-kafka package")


def stream_options(brokers: str, topics: Iterable[str], earliest: bool = False, max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of a topic stream. ``earliest`` matters only until the checkpoint
    holds offsets of a topic. A trigger takes all there is, unless it is given a limit."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(sorted(topics)),
        "startingOffsets": "earliest" if earliest else "latest",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def replay_options(brokers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }


def stream_topics(spark: SparkSession, brokers: str, topics: Iterable[str], earliest: bool = False, max_per_trigger: int | None = None) -> DataFrame:
    _require(spark)
    options = stream_options(brokers, topics, earliest, max_per_trigger)
    return spark.readStream.format("kafka").options(**options).load().select("topic", "value", "timestamp")


def replay_topic(spark: SparkSession, brokers: str, topic: str) -> DataFrame:
    """Every message of one topic; ``metrics.replay_rates`` reports how fast they come."""
    _require(spark)
    reader = spark.read.format("kafka").options(**replay_options(brokers, topic))
    return reader.load().select("topic", "value", "partition", "offset", "timestamp")
