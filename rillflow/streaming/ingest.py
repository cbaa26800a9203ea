"""The ingest plan as a stream.

Every micro-batch writes into folders named after its query and batch id and
overwrites them, so a batch that is run again after a failure leaves the same
files: rows, quarantine and counters arrive exactly once. The query's id is the
one Spark keeps with the checkpoint: two queries, or a query with a new
checkpoint, never touch each other's folders.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rillflow.operators.catalog import disable_topics
from rillflow.operators.metrics import minute_counters
from rillflow.operators.quality import (
    ERROR_THRESHOLD,
    ERROR_TOTALS_SCHEMA,
    add_errors,
    errors_per_topic,
    keyed_rows,
    split_by_error,
    with_hour_key,
)
from rillflow.operators.tables import schemas_by_topic
from rillflow.plans.ingest import IngestPipeline, IngestPlan, parsed_rows, with_rejected
from rillflow.sinks.landing import batch_folder
from rillflow.sinks.reports import publish_counters
from rillflow.sources.kafka import BATCH_MILLIS
from rillflow.sources.store import names_in, remove

# Fixed value: milliseconds after which landed files are rolled over.
ROLLOVER_MILLIS = 600_000


@dataclass
class StreamPlan:
    """Folders of a streaming ingest. ``load_catalog`` is called for every
    micro-batch, so catalog changes take effect without a restart. With an
    ``errors`` folder, errors count across micro-batches and topics that pass the
    threshold go to ``on_flagged``. With ``typed``, Parquet topics land by the
    schema of their table; topics that are new to a micro-batch's catalog, or had
    no table before, are described then."""

    ingest: IngestPlan
    load_catalog: Callable[[], DataFrame]
    checkpoint: str
    quarantine: str | None = None
    counters: str | None = None
    errors: str | None = None
    on_flagged: Callable[[DataFrame], None] | None = None
    error_threshold: int = ERROR_THRESHOLD
    typed: bool = False


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps with a checkpoint, for as long as it exists."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


class IngestStream:
    """A running ingest: its pipeline is built once and closed when the query has ended."""

    def __init__(self, plan: StreamPlan, run: str | None = None):
        self.plan = plan
        self.run = run
        self.pipeline = IngestPipeline(plan.ingest)
        self.schemas = dict(plan.ingest.schemas or {})

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: land, quarantine, count.

        The parsed rows feed several writes, so they are kept for the batch and
        dropped at its end. A lost executor's share is parsed again from the source.
        """
        plan = self.plan
        if self.run is None:
            self.run = query_id(batch.sparkSession, plan.checkpoint)
        catalog = plan.load_catalog()
        if plan.typed:
            self.schemas = schemas_by_topic(catalog, self.schemas)
        parsed = parsed_rows(batch, catalog, plan.ingest.avro_schemas).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            split = split_by_error(parsed)
            _, rejected = self.pipeline.apply(split.good, replace(plan.ingest, run=self.run, batch=str(batch_id), mode="overwrite", schemas=self.schemas))
            failed = with_rejected(split.bad, rejected).select("topic", "value", "error").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                self._report(split.good, failed, batch_id)
            finally:
                failed.unpersist()
            if plan.errors:
                flag_topics(plan, errors_per_topic(parsed), self.run, batch_id)
        finally:
            self.pipeline.remove_staged(batch)
            parsed.unpersist()

    def _report(self, good: DataFrame, bad: DataFrame, batch_id: int) -> None:
        plan = self.plan
        if plan.quarantine:
            bad.write.mode("overwrite").parquet(batch_folder(plan.quarantine, self.run, str(batch_id)))
        if plan.counters:
            landed = minute_counters(good, "in")
            failed = minute_counters(bad.withColumn("ts", F.current_timestamp()), "error")
            publish_counters(landed.unionByName(failed), plan.counters, self.run, str(batch_id))

    def close(self) -> None:
        self.pipeline.close()


def flag_topics(plan: StreamPlan, batch_errors: DataFrame, run: str, batch_id: int) -> None:
    """Error totals after this batch, built on the newest before it, and the
    topics that passed the threshold handed to ``on_flagged``.

    Totals are kept per batch, so a batch that is run again starts from the same
    totals. Counting starts where the query has no totals yet; totals that are
    there and cannot be read fail the batch.
    """
    spark = batch_errors.sparkSession
    root = f"{plan.errors}/run={run}"
    earlier = sorted(int(name[6:]) for name in names_in(spark, root) if name.startswith("batch=") and int(name[6:]) < batch_id)
    totals = spark.createDataFrame([], ERROR_TOTALS_SCHEMA)
    if earlier:
        totals = spark.read.schema(ERROR_TOTALS_SCHEMA).parquet(f"{root}/batch={earlier[-1]}")
    current = f"{root}/batch={batch_id}"
    add_errors(totals, batch_errors, plan.error_threshold).coalesce(1).write.mode("overwrite").parquet(current)
    for old in earlier[:-1]:
        remove(spark, f"{root}/batch={old}")
    if plan.on_flagged:
        plan.on_flagged(spark.read.parquet(current).filter("newly_flagged").select("topic"))


def start_ingest(messages: DataFrame, plan: StreamPlan, available_now: bool = False, interval_ms: int = BATCH_MILLIS) -> StreamingQuery:
    """Start the stream. Its read position is the checkpoint."""
    writer = messages.writeStream.foreachBatch(IngestStream(plan))
    return with_trigger(writer.option("checkpointLocation", plan.checkpoint), available_now, interval_ms).start()


def with_trigger(writer: DataStreamWriter, available_now: bool = False, interval_ms: int = BATCH_MILLIS) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{interval_ms} milliseconds")


def start_text_landing(parsed: DataFrame, path: str, checkpoint: str, codec: str = "gzip", available_now: bool = False, interval_ms: int = ROLLOVER_MILLIS, max_records: int = 0) -> StreamingQuery:
    """Good rows of a parsed stream straight to text files by topic and hour.

    The file sink commits each micro-batch once; the interval is the rollover
    time and ``max_records`` bounds a file.
    """
    good = keyed_rows(with_hour_key(parsed.filter(F.col("error").isNull())))
    writer = (
        good.select("topic", "hour", F.col("message").alias("value"))
        .writeStream.format("text")
        .partitionBy("topic", "hour")
        .option("compression", codec)
        .option("maxRecordsPerFile", max_records)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer, available_now, interval_ms).start()


def drain(query: StreamingQuery) -> None:
    """Finish what has arrived, then stop."""
    query.processAllAvailable()
    query.stop()


def disable_flagged(load_catalog: Callable[[], DataFrame], save: Callable[[DataFrame], None]) -> Callable[[DataFrame], None]:
    """An ``on_flagged`` action that stores the catalog with flagged topics disabled."""

    def act(flagged: DataFrame) -> None:
        if not flagged.isEmpty():
            save(disable_topics(load_catalog(), flagged))

    return act

