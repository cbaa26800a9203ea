"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Each query runs
to a sink that discards its rows; the time is the best of ``BENCH_RUNS`` runs
after one that warms the JVM up, or one run for queries that write many folders. ``messages_per_sec`` is the throughput of the
queries that handle a known number of messages.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from rillflow.operators.metrics import topic_hour_counts  # noqa: E402
from rillflow.operators.parse import parse_messages, parse_with_descriptor  # noqa: E402
from rillflow.operators.quality import keyed_rows, split_by_error, with_hour_key  # noqa: E402
from rillflow.queries import all_queries  # noqa: E402
from rillflow.queries.feeds import bytes_of, make_catalog, table  # noqa: E402
from rillflow.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

QUERIES = [
    "topic_hour_counts", "multi_format_parse", "txt_range", "txt_rejoin", "catalog_join", "quarantine_split",
    "minute_counters", "rate_windows", "pipe_match", "pipe_definition", "codec_landing", "publish_lake", "stream_ingest",
]

# These write thousands of directories, one for each topic and hour; they run once.
WRITING = {"codec_landing", "publish_lake", "stream_ingest"}


def shipment_messages(spark):
    """A message per line item, its return flag as the topic."""
    ms = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    line = F.concat_ws("|", "l_orderkey", "l_partkey", "l_returnflag", ms)
    return table(spark, SF_DIR, "lineitem").select(F.col("l_returnflag").alias("topic"), bytes_of(line).alias("value"))


def shipment_catalog(spark):
    formats = {"A": "txt:sep=pipe;ts=3;msg=0:3", "N": "txt:sep=pipe;ts=3;msg=1", "R": "txt:sep=pipe;ts_ms=3"}
    return make_catalog(spark, [{"log": topic, "format": text} for topic, text in formats.items()])


def message_runs(spark):
    """Throughput queries over every line item."""
    return {
        "messages_parse_literal": lambda: parse_with_descriptor(shipment_messages(spark), "txt:sep=pipe;ts=3;msg=0:3"),
        "messages_parse_catalog": lambda: split_by_error(parse_messages(shipment_messages(spark), shipment_catalog(spark))).good,
        "messages_topic_hours": lambda: topic_hour_counts(
            keyed_rows(with_hour_key(parse_messages(shipment_messages(spark), shipment_catalog(spark))))
        ),
    }


def timed(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session("rillflow-bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        # Small files otherwise end up in one task; a cluster's inputs are larger.
        "spark.sql.files.maxPartitionBytes": "2m",
    })
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    runs = {name: (lambda q=registered[name]: q.run(spark, SF_DIR)) for name in QUERIES}
    runs.update(message_runs(spark))
    seconds = {}
    for name, build in runs.items():
        if name not in WRITING:
            timed(build)
        seconds[name] = round(min(timed(build) for _ in range(1 if name in WRITING else RUNS)), 3)
    messages = table(spark, SF_DIR, "lineitem").count()
    rates = {name: round(messages / seconds[name]) for name in seconds if name.startswith("messages_")}
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "messages_per_sec": rates,
    }))


if __name__ == "__main__":
    main()
