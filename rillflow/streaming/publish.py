"""The publish plan as a stream over landed files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rillflow.operators.catalog import PublishDefaults
from rillflow.plans.publish import publish_batches, register_partitions
from rillflow.sinks.reports import append_audit
from rillflow.sources.store import make_folder
from rillflow.streaming.ingest import with_trigger

# Fixed value: milliseconds between two publish rounds.
PUBLISH_INTERVAL_MS = 1_000


def start_publish(
    spark: SparkSession,
    landing: str,
    load_catalog: Callable[[], DataFrame],
    checkpoint: str,
    defaults: PublishDefaults = PublishDefaults(),
    available_now: bool = False,
    interval_ms: int = PUBLISH_INTERVAL_MS,
    register: bool = True,
    writers: int | None = None,
    parquet_schema: StructType | None = None,
    audit_path: str | None = None,
) -> StreamingQuery:
    """Publish every batch that ingest lands, once.

    The stream follows the notes ingest leaves of what it landed; no landed row
    is read to find them. A round reads the folders of its new batches alone and
    adds their rows under the batches' names, so a round that is run again, or a
    second publisher, changes nothing. Text is published, and with a
    ``parquet_schema`` also Parquet. The landing folder may still be empty.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        found = batch.select("kind", "run", "batch").distinct().collect()
        catalog = load_catalog()
        for kind, schema in (("text", None), ("parquet", parquet_schema)):
            batches = sorted((r["run"], r["batch"]) for r in found if r["kind"] == kind)
            if not batches or (kind == "parquet" and schema is None):
                continue
            settings = publish_batches(spark, landing, batches, catalog, defaults, schema, writers=writers)
            try:
                if register:
                    audit = register_partitions(spark, settings)
                    if audit_path:
                        append_audit(audit, audit_path)
            finally:
                settings.unpersist()

    make_folder(spark, f"{landing}/hours")
    notes = spark.readStream.schema("topic string, hour string").option("recursiveFileLookup", True).parquet(f"{landing}/hours")
    path = F.col("_metadata.file_path")
    named = notes.select(*[F.regexp_extract(path, r"/hours/(\w+)/run=([^/]*)/batch=([^/]*)/", i + 1).alias(n) for i, n in enumerate(("kind", "run", "batch"))])
    writer = named.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return with_trigger(writer, available_now, interval_ms).start()
