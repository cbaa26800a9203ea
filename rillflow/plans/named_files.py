"""Publishing files that others finish in a folder, named ``topic-yyyy-MM-dd-HH...``.

A round takes the files that have rested long enough, checks them, publishes the
rows of the sound ones, moves the others to quarantine, writes an audit row per
file, and removes what it published. It begins with a ledger entry, moved in by
one rename, that says what will be done with each file; a round that was stopped
is finished by that entry before a new one begins, so a file is published once
or quarantined once, whenever a publisher stops. Rounds of a folder are run by
one job.

File names pass the driver, rows and bytes never.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow.functions.keys import file_hour, file_topic, parse_hour_key
from rillflow.operators.catalog import PublishDefaults
from rillflow.operators.lookup import lookup_join
from rillflow.operators.tables import conform_columns, schema_groups
from rillflow.plans import versions
from rillflow.plans.publish import quarantine_files, rows_of_named_files
from rillflow.sinks.reports import file_audit
from rillflow.sources.files import FILE_WAIT_MS, check_files, finished_files, literal_path, plain_path
from rillflow.sources.store import exists, make_folder, move, names_in, remove

LEDGER_SCHEMA = "path string, length bigint, topic string, hour string, schema string, status string"
AUDIT_SCHEMA = "push_ts timestamp, log_name string, file_name string, dir string, host string, file_size bigint, status string, round string"

# What becomes of a file.
PUBLISHED = "complete"
CORRUPT = "corrupt"
UNNAMED = "unnamed"

# Fixed value: milliseconds between two rounds.
ROUND_INTERVAL_MS = 1_000


def _numbers(spark: SparkSession, folder: str) -> set[int]:
    return {int(n[6:]) for n in names_in(spark, folder) if n.startswith("round=")}


def round_files(
    spark: SparkSession, root: str, schemas: Mapping[str, StructType] | None = None, wait_ms: int = FILE_WAIT_MS, now: datetime | None = None,
) -> DataFrame:
    """What a round would do with the finished files below ``root``.

    A Parquet file is published by its topic's schema, kept with it; those of topics without one wait.
    """
    path = F.col("path")
    checked = check_files(finished_files(spark, root, wait_ms, now), root)
    named = checked.withColumns({"topic": file_topic(path), "hour": file_hour(path)})
    known = [(topic, schema.json()) for schema, topics in schema_groups(schemas or {}).values() for topic in topics]
    described = spark.createDataFrame(known, "_topic string, schema string")
    named = lookup_join(named, described, "topic", "_topic")
    columnar = path.endswith(".parquet")
    usable = F.col("topic").isNotNull() & parse_hour_key(F.col("hour")).isNotNull()
    status = F.when(~F.col("file_ok"), F.lit(CORRUPT)).when(~usable, F.lit(UNNAMED)).otherwise(F.lit(PUBLISHED))
    waits = (status == PUBLISHED) & columnar & F.col("schema").isNull()
    return named.filter(~waits).select("path", "length", "topic", "hour", F.when(columnar, F.col("schema")).alias("schema"), status.alias("status"))


def begin_round(
    spark: SparkSession, root: str, log: str, schemas: Mapping[str, StructType] | None = None, wait_ms: int = FILE_WAIT_MS, now: datetime | None = None,
) -> int | None:
    """Enters the finished files in the ledger as a new round; its number, or None when there are none."""
    staged = f"{log}/_staged/{uuid.uuid4().hex}"
    round_files(spark, root, schemas, wait_ms, now).coalesce(1).write.parquet(staged)
    if spark.read.schema(LEDGER_SCHEMA).parquet(staged).isEmpty():
        remove(spark, staged)
        return None
    number = max(_numbers(spark, f"{log}/ledger"), default=-1) + 1
    make_folder(spark, f"{log}/ledger")
    move(spark, staged, f"{log}/ledger/round={number}")
    return number


def _rows_of(spark: SparkSession, paths: list[str], schema: StructType | None) -> DataFrame:
    """The rows of files of one kind; columns of Parquet files are matched with the schema by name."""
    source = [literal_path(p) for p in paths]
    name = plain_path(F.col("_metadata.file_path")).alias("file")
    if schema is None:
        return rows_of_named_files(spark.read.text(source).select("value", name))
    found = spark.read.option("mergeSchema", True).parquet(*source)
    return rows_of_named_files(found.select(*conform_columns(found, schema), name))


def finish_round(spark: SparkSession, log: str, number: int, catalog: DataFrame, defaults: PublishDefaults = PublishDefaults(), host: str = "") -> None:
    """Does what the ledger says of a round; each step may be done again.

    Files are removed after their audit rows are written, and a publication that
    is in the manifest is not read for again, so a removed file is never missed.
    """
    files = spark.read.schema(LEDGER_SCHEMA).parquet(f"{log}/ledger/round={number}")
    good = files.filter(F.col("status") == PUBLISHED)
    kinds = sorted((r["schema"] for r in good.select("schema").distinct().collect()), key=lambda s: s or "")
    for kind in kinds:
        name = f"files-{number}" + (f"-{hashlib.md5(kind.encode()).hexdigest()}" if kind else "")
        if exists(spark, f"{log}/manifest/publication={name}"):
            continue
        mine = good.filter(F.col("schema").eqNullSafe(F.lit(kind)))
        schema = StructType.fromJson(json.loads(kind)) if kind else None
        rows = _rows_of(spark, [r["path"] for r in mine.select("path").toLocalIterator()], schema)
        versions.publish_increment(rows, mine.select("topic", "hour").distinct(), catalog, log, name, defaults, fmt="parquet" if kind else "text")
    moved = quarantine_files(spark, files.withColumn("file_ok", F.col("status") == PUBLISHED), catalog, defaults, f"round-{number}")
    places = files.join(moved.select("path", "target"), "path", "left").withColumn("path", F.coalesce("target", "path"))
    audit = file_audit(places, F.col("topic"), F.lit(host), F.col("status"))
    audit.coalesce(1).write.mode("overwrite").parquet(f"{log}/audit/round={number}")
    for row in good.select("path").toLocalIterator():
        remove(spark, row["path"])
    make_folder(spark, f"{log}/done/round={number}")


def publish_named_files(
    spark: SparkSession, root: str, log: str, catalog: DataFrame, defaults: PublishDefaults = PublishDefaults(), host: str = "",
    schemas: Mapping[str, StructType] | None = None, wait_ms: int = FILE_WAIT_MS, now: datetime | None = None,
) -> list[int]:
    """One pass: finishes the rounds that were stopped, then runs a new one; the numbers of those done.

    ``log`` also holds the manifest of what is published: see ``versions.read_published``.
    """
    done = sorted(_numbers(spark, f"{log}/ledger") - _numbers(spark, f"{log}/done"))
    for number in done:
        finish_round(spark, log, number, catalog, defaults, host)
    number = begin_round(spark, root, log, schemas, wait_ms, now)
    if number is not None:
        finish_round(spark, log, number, catalog, defaults, host)
        done.append(number)
    return done


def follow_folder(
    spark: SparkSession, root: str, log: str, load_catalog: Callable[[], DataFrame], stop: Event, interval_ms: int = ROUND_INTERVAL_MS, **options,
) -> None:
    """Passes over a folder until ``stop`` is set, each with the catalog of its time; a pass that has begun is finished."""
    while not stop.is_set():
        publish_named_files(spark, root, log, load_catalog(), **options)
        stop.wait(interval_ms / 1000)


def read_audit(spark: SparkSession, log: str) -> DataFrame:
    """An audit row of every file of every round; files in quarantine are named where they are now."""
    folder = f"{log}/audit"
    return spark.read.schema(AUDIT_SCHEMA).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], AUDIT_SCHEMA)


def upload_meters(spark: SparkSession, log: str) -> DataFrame:
    """Files and bytes by topic and status, over all rounds."""
    return read_audit(spark, log).groupBy(F.col("log_name").alias("topic"), "status").agg(F.count("*").alias("files"), F.sum("file_size").alias("bytes"))
