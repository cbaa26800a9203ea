"""Counter, audit and search-document outputs, and the broker sink."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillflow.functions.descriptors import TEXT_TYPE
from rillflow.functions.keys import base_name
from rillflow.sources.kafka import has_kafka_package
from rillflow.sources.store import make_folder, move, names_in, remove

# Fixed value: seconds a counter lives after its last increment.
COUNTER_EXPIRY_SECONDS = 86_400

SNAPSHOTS = "_snapshots"
SUMS_SCHEMA = "phase string, topic string, minute string, n bigint, updated_at timestamp"
FOLDED_SCHEMA = "run string, first bigint, last bigint"
COUNTER_SCHEMA = "phase string, topic string, minute string, n bigint, updated_at timestamp, run string, batch string"


def publish_counters(counters: DataFrame, path: str, run: str, batch: str) -> None:
    """Adds a batch of increments to the counter table.

    Increments are stored per run and batch and summed on reading, so a batch
    that is run again replaces its own increments and is not counted twice.
    """
    stamped = counters.withColumn("updated_at", F.current_timestamp())
    stamped.coalesce(1).write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch}")


def expire_counters(spark: SparkSession, path: str, now: Column | None = None, expiry_seconds: int = COUNTER_EXPIRY_SECONDS) -> int:
    """Removes the increments of batches in which every counter has expired; returns how many batches.

    The batches' newest increments, one row each, pass the driver.
    """
    now = F.current_timestamp() if now is None else now
    newest = spark.read.schema(COUNTER_SCHEMA).parquet(path).groupBy("run", "batch").agg(F.max("updated_at").alias("at"))
    old = newest.filter(F.unix_micros("at") <= F.unix_micros(now) - expiry_seconds * 1_000_000).collect()
    for row in old:
        remove(spark, f"{path}/run={row['run']}/batch={row['batch']}")
    return len(old)


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[8:]) for n in names_in(spark, f"{path}/{SNAPSHOTS}") if n.startswith("version="))


def _snapshot(spark: SparkSession, path: str, version: int | None) -> tuple[DataFrame, DataFrame]:
    """Sums of what is folded, and the batches in them as ranges of a run's numbers."""
    if version is None:
        return spark.createDataFrame([], SUMS_SCHEMA), spark.createDataFrame([], FOLDED_SCHEMA)
    folder = f"{path}/{SNAPSHOTS}/version={version}"
    return spark.read.schema(SUMS_SCHEMA).parquet(f"{folder}/sums"), spark.read.schema(FOLDED_SCHEMA).parquet(f"{folder}/folded")


def _numbered(batch: Column) -> Column:
    """The number of a batch, NULL for names that are no plain number: those are never folded."""
    return F.when(batch.rlike("^(0|[1-9][0-9]*)$"), batch.try_cast("bigint"))


def _unfolded(spark: SparkSession, path: str, folded: DataFrame) -> DataFrame:
    """Increments of batches that no range holds; a folded batch that is written again is left out."""
    rows = spark.read.schema(COUNTER_SCHEMA).parquet(path).withColumn("_number", _numbered(F.col("batch")))
    ranges = folded.withColumnRenamed("run", "_run")
    within = (F.col("run") == F.col("_run")) & F.col("_number").between(F.col("first"), F.col("last"))
    return rows.join(ranges, within, "left_anti")


def fold_counters(spark: SparkSession, path: str, keep: int = 1, now: Column | None = None, expiry_seconds: int = COUNTER_EXPIRY_SECONDS) -> int:
    """Adds increments to a new snapshot; returns how many batches it took.

    Each run's newest ``keep`` batches stay increments, as a stream may run them
    again with other rows. Which batches are in a snapshot is kept as ranges, one
    a run where its batches have no gaps, so a folded batch that is published
    again counts once and one that comes late still counts. A snapshot is seen by
    one rename. The increments in it are removed by the next fold, with the
    snapshot before it, so readers have that long to end. One job folds. Counters
    that have expired are not taken over.
    """
    now = F.current_timestamp() if now is None else now
    found = _versions(spark, path)
    newest = found[-1] if found else None
    sums, folded = _snapshot(spark, path, newest)
    _remove_folded(spark, path, folded, found[:-1])
    rows = _unfolded(spark, path, folded)
    numbered = rows.filter(F.col("_number").isNotNull()).select("run", "_number").distinct()
    place = F.row_number().over(Window.partitionBy("run").orderBy(F.desc("_number")))
    # Written first: a batch that comes while this runs is in the snapshot's rows and ranges, or in neither.
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    chosen = f"{path}/_chosen-{uuid.uuid4().hex}"
    numbered.withColumn("place", place).filter(F.col("place") > keep).drop("place").write.parquet(chosen)
    batches = spark.read.schema("run string, _number bigint").parquet(chosen)
    count = batches.count()
    if count:
        taken = rows.join(batches, ["run", "_number"], "left_semi").select("phase", "topic", "minute", "n", "updated_at")
        alive = F.unix_micros("updated_at") > F.unix_micros(now) - expiry_seconds * 1_000_000
        _summed(sums.unionByName(taken)).filter(alive).write.parquet(f"{staged}/sums")
        _ranges(folded.unionByName(batches.select("run", F.col("_number").alias("first"), F.col("_number").alias("last")))).coalesce(1).write.parquet(f"{staged}/folded")
        make_folder(spark, f"{path}/{SNAPSHOTS}")
        move(spark, staged, f"{path}/{SNAPSHOTS}/version={0 if newest is None else newest + 1}")
    remove(spark, chosen)
    return count


def _ranges(batches: DataFrame) -> DataFrame:
    """Ranges of numbers that follow each other joined, per run."""
    by_run = Window.partitionBy("run").orderBy("first")
    starts = (F.col("first") > F.lag("last").over(by_run) + 1).cast("int")
    return (
        batches.withColumn("starts", F.coalesce(starts, F.lit(0)))
        .withColumn("part", F.sum("starts").over(by_run))
        .groupBy("run", "part").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("part")
    )


def _remove_folded(spark: SparkSession, path: str, folded: DataFrame, outdated: list[int]) -> None:
    """Folders of increments that the newest snapshot holds, by their names, and the snapshots before it."""
    held: dict[str, list[tuple[int, int]]] = {}
    for row in folded.toLocalIterator():
        held.setdefault(row["run"], []).append((row["first"], row["last"]))
    for run, ranges in held.items():
        for name in names_in(spark, f"{path}/run={run}"):
            number = name.removeprefix("batch=")
            if number.isdecimal() and str(int(number)) == number and any(a <= int(number) <= b for a, b in ranges):
                remove(spark, f"{path}/run={run}/{name}")
    for version in outdated:
        remove(spark, f"{path}/{SNAPSHOTS}/version={version}")


def _summed(increments: DataFrame) -> DataFrame:
    return increments.groupBy("phase", "topic", "minute").agg(F.sum("n").alias("n"), F.max("updated_at").alias("updated_at"))


def live_counters(spark: SparkSession, path: str, now: Column | None = None, expiry_seconds: int = COUNTER_EXPIRY_SECONDS) -> DataFrame:
    """Sum per key over the newest snapshot and the batches after it, without keys not incremented for ``expiry_seconds``."""
    now = F.current_timestamp() if now is None else now
    found = _versions(spark, path)
    sums, folded = _snapshot(spark, path, found[-1] if found else None)
    increments = _unfolded(spark, path, folded).select("phase", "topic", "minute", "n", "updated_at")
    alive = F.unix_micros("updated_at") > F.unix_micros(now) - expiry_seconds * 1_000_000
    return _summed(sums.unionByName(increments)).filter(alive).drop("updated_at")


def file_audit(files: DataFrame, topic: Column, host: Column, status: Column, ts: Column | None = None) -> DataFrame:
    """One row per published file (``path``, ``length``)."""
    return files.select(
        (F.current_timestamp() if ts is None else ts).alias("push_ts"),
        topic.alias("log_name"),
        base_name(F.col("path")).alias("file_name"),
        F.regexp_replace("path", r"/[^/]*$", "").alias("dir"),
        host.alias("host"),
        F.col("length").alias("file_size"),
        status.alias("status"),
    )


def partition_audit(partitions: DataFrame, exception: Column | None = None, ts: Column | None = None) -> DataFrame:
    """One row per partition registration (``topic``, ``dt``, ``hr``)."""
    failure = F.lit(None).cast("string") if exception is None else exception
    return partitions.select(
        (F.current_timestamp() if ts is None else ts).alias("ts"),
        F.col("topic").alias("log"),
        F.concat(F.lit("dt="), "dt", F.lit(",hr="), "hr").alias("partition"),
        F.when(failure.isNull(), F.lit("ok")).otherwise(F.lit("error")).alias("status"),
        failure.alias("exception"),
    )


def append_audit(audit: DataFrame, path: str) -> None:
    audit.write.mode("append").parquet(path)


def search_documents(parsed: DataFrame) -> DataFrame:
    """Search documents of text messages: their first field as ``searchField``.

    Only parsed text messages have fields; rows of other types are not documents.
    """
    text = parsed.filter((F.col("format_type") == TEXT_TYPE) & F.col("error").isNull())
    return text.select("topic", F.get("fields", F.lit(0)).alias("searchField"))


def send_to_broker(rows: DataFrame, brokers: str) -> None:
    """``topic, value`` rows to a Kafka broker."""
    if not has_kafka_package(rows.sparkSession):
        raise RuntimeError("start the session with the spark-sql-kafka package")
    rows.select("topic", "value").write.format("kafka").option("kafka.bootstrap.servers", brokers).save()
