"""Keeps the running topic streams equal to the enabled topics of a group.

A running query cannot change its subscription, so each topic has a query of its
own with its own checkpoint: a topic that is enabled again continues where it
stopped, and nothing sent meanwhile is lost.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rillflow.operators.catalog import enabled_topics, topics_to_start, topics_to_stop

logger = logging.getLogger(__name__)

# Fixed value: milliseconds between two looks at the catalog.
TOPIC_REFRESH_MS = 10_000


def active_topics(spark: SparkSession, running: dict[str, StreamingQuery]) -> DataFrame:
    return spark.createDataFrame([(t,) for t, q in running.items() if q.isActive], "log string")


def reconcile(
    catalog: DataFrame, group: str, running: dict[str, StreamingQuery], start: Callable[[str], StreamingQuery]
) -> tuple[list[str], list[str]]:
    """Start queries of newly enabled topics and stop those of disabled ones.

    ``running`` is updated in place. A query that failed is no longer active and
    its topic is started again, from its checkpoint. Returns the topics started
    and stopped.
    """
    spark = catalog.sparkSession
    enabled = enabled_topics(catalog, group)
    active = active_topics(spark, running)
    starting = sorted(r["log"] for r in topics_to_start(enabled, active).toLocalIterator())
    stopping = sorted(r["log"] for r in topics_to_stop(enabled, active).toLocalIterator())
    for topic in stopping:
        running.pop(topic).stop()
    for topic in [t for t, q in running.items() if not q.isActive]:
        running.pop(topic)
    for topic in starting:
        running[topic] = start(topic)
    return starting, stopping


def follow_catalog(
    load_catalog: Callable[[], DataFrame], group: str, start: Callable[[str], StreamingQuery],
    stopped: threading.Event, interval_ms: int = TOPIC_REFRESH_MS,
) -> dict[str, StreamingQuery]:
    """Keeps the queries equal to the catalog until ``stopped`` is set; then stops them all and returns them.

    A look at the catalog that fails is logged and tried again at the next interval.
    """
    running: dict[str, StreamingQuery] = {}
    while True:
        try:
            reconcile(load_catalog(), group, running, start)
        except Exception:
            logger.exception("topics could not be refreshed")
        if stopped.wait(interval_ms / 1000):
            break
    for query in running.values():
        query.stop()
    return running
