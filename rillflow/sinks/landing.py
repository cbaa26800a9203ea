"""Landed files: one directory per topic and hour.

Rows carry ``topic``, ``hour`` (``yyyy-MM-dd-HH``), ``codec`` and ``message``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rillflow.functions.avro import has_avro_package
from rillflow.operators.quality import keyed_rows
from rillflow.operators.tables import conform_columns, schema_groups
from rillflow.sources.files import list_files
from rillflow.sources.store import exists, remove

# Codecs of landed text, and the page compression of landed Parquet.
TEXT_CODECS = ("none", "gzip", "snappy", "bzip2")
PARQUET_CODEC = "gzip"

LANDING_PARTITIONS = ("topic", "hour")
LANDED_TEXT_SCHEMA = "value string, topic string, hour string"
HOURS_SCHEMA = "topic string, hour string, run string, batch string"
COLUMNAR_CODECS = ("parquet", "avro")
KINDS = ("text", "parquet", "avro", "tables")
_PLACE = [StructField(name, StringType()) for name in ("topic", "hour", "run", "batch")]


def gather(rows: DataFrame, keys: tuple[str, ...], writers: int | None = None) -> DataFrame:
    """Brings the rows of a directory together before a write.

    Adaptive execution cuts a directory with much data into tasks of the
    advisory partition size and joins small ones, so one hot topic-hour is
    written by many tasks. With a fixed number of ``writers``, as in a
    micro-batch, each key is spread over that many instead, by the rows' places
    in their partitions, so that equal rows are spread too. ``writers=0`` keeps
    the tasks as they are, without a shuffle, for input already ordered by time.
    """
    if writers == 0:
        return rows
    if writers:
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(writers))
        return rows.withColumn("_writer", salt).repartition(*keys, "_writer").drop("_writer")
    return rows.hint("rebalance", *keys)


def land_text(rows: DataFrame, path: str, codec: str = "gzip", mode: str = "append", writers: int | None = None, max_records: int = 0, message: str = "message") -> None:
    """Messages as lines, one file set per topic and hour. Rows without a topic or
    an hour are not written here."""
    lines = keyed_rows(rows).select(*LANDING_PARTITIONS, F.col(message).alias("value"))
    (
        gather(lines, LANDING_PARTITIONS, writers)
        .write.mode(mode)
        .partitionBy(*LANDING_PARTITIONS)
        .option("compression", codec)
        .option("maxRecordsPerFile", max_records)
        .text(path)
    )


def land_parquet(rows: DataFrame, path: str, schema: StructType, mode: str = "append", writers: int | None = None, max_records: int = 0) -> None:
    """Rows with the columns of a table schema, matched by name."""
    keyed = keyed_rows(rows)
    data = StructType([f for f in schema.fields if f.name not in LANDING_PARTITIONS])
    columns = [*conform_columns(keyed, data), *LANDING_PARTITIONS]
    (
        gather(keyed.select(*columns), LANDING_PARTITIONS, writers)
        .write.mode(mode)
        .partitionBy(*LANDING_PARTITIONS)
        .option("compression", PARQUET_CODEC)
        .option("maxRecordsPerFile", max_records)
        .parquet(path)
    )


def land_avro(rows: DataFrame, path: str, schema_json: str | None = None, mode: str = "append", writers: int | None = None) -> None:
    """Rows as Avro files; with a schema their columns must be those of the schema."""
    if not has_avro_package(rows.sparkSession):
        raise RuntimeError("start the session with the spark-avro package")
    keyed = keyed_rows(rows)
    writer = gather(keyed, LANDING_PARTITIONS, writers).write.mode(mode).partitionBy(*LANDING_PARTITIONS)
    if schema_json:
        writer = writer.option("avroSchema", schema_json)
    writer.format("avro").save(path)


def batch_folder(root: str, run: str, batch: str) -> str:
    """The folder of one batch of one run. A run is a streaming query or a batch
    job; two runs never share a folder, whatever their batches are called."""
    return f"{root}/run={run}/batch={batch}"


def with_sink(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose codec has a sink and that name a topic, and the others with an ``error``."""
    known = F.coalesce(F.col("codec").isin(*TEXT_CODECS, *COLUMNAR_CODECS), F.lit(False))
    named = F.coalesce(F.col("topic") != "", F.lit(False))
    error = F.when(~named, F.lit("message has no topic")).otherwise(F.concat(F.lit("no sink for codec "), F.coalesce("codec", F.lit("NULL"))))
    return rows.filter(known & named), rows.filter(~(known & named)).withColumn("error", error)


def land_by_codec(
    rows: DataFrame, path: str, schema: StructType | None = None, run: str = "batch", batch: str = "0", mode: str = "append", writers: int | None = None,
    schemas: Mapping[str, StructType] | None = None,
) -> DataFrame:
    """Each row with its own codec: text below ``path/text``, Parquet below
    ``path/parquet``, Avro below ``path/avro``, each with a folder per run and batch.

    There is one write per codec that the rows have, as a write has one codec;
    the rows should be staged or persisted, since each write reads them. Parquet
    and Avro rows take ``schema``, or their time and fields when there is none.
    Parquet rows of topics in ``schemas`` take their topic's schema instead, below
    ``path/tables``, in one write per schema, however many topics share it.
    Returns the rows that no sink takes, with the reason.
    """
    landable, rejected = with_sink(rows)
    groups = schema_groups(schemas or {})
    own = F.lit(None).cast("string")
    for fingerprint, (_, topics) in groups.items():
        own = F.when((F.col("codec") == "parquet") & F.col("topic").isin(topics), F.lit(fingerprint)).otherwise(own)
    landable = landable.withColumn("_schema", own)
    found = landable.select("codec", "_schema").distinct().collect()
    codecs = sorted({r["codec"] for r in found if r["_schema"] is None})
    if mode == "overwrite":
        # A topic's schema may have changed since the batch ran before.
        remove(rows.sparkSession, batch_folder(f"{path}/tables", run, batch))
    for fingerprint in sorted(r["_schema"] for r in found if r["_schema"]):
        mine = landable.filter(F.col("_schema") == fingerprint).drop("_schema")
        land_parquet(mine, f"{batch_folder(f'{path}/tables', run, batch)}/schema_id={fingerprint}", groups[fingerprint][0], mode, writers)
    landable = landable.filter(F.col("_schema").isNull()).drop("_schema")
    if "avro" in codecs and not has_avro_package(rows.sparkSession):
        raise RuntimeError("start the session with the spark-avro package")
    for codec in codecs:
        mine = landable.filter(F.col("codec") == codec)
        columns = schema or StructType([f for f in rows.schema.fields if f.name in ("ts", "fields")])
        if codec == "parquet":
            land_parquet(mine, batch_folder(f"{path}/parquet", run, batch), columns, mode, writers)
        elif codec == "avro":
            names = [f.name for f in columns.fields if f.name not in LANDING_PARTITIONS]
            land_avro(mine.select(*names, *LANDING_PARTITIONS), batch_folder(f"{path}/avro", run, batch), mode=mode, writers=writers)
        else:
            land_text(mine, f"{batch_folder(f'{path}/text', run, batch)}/codec={codec}", codec, mode, writers)
    record_hours(rows.sparkSession, path, run, batch)
    return rejected


def hours_of_files(files: DataFrame) -> DataFrame:
    """Distinct ``topic, hour`` of landed files, from their directory names."""
    def part(name: str) -> Column:
        raw = F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
        # Spark writes special characters of a directory value as %XX and leaves
        # the plus sign alone, which URL decoding would turn into a space.
        return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))).alias(name)

    return files.select(part("topic"), part("hour")).distinct()


def record_hours(spark: SparkSession, path: str, run: str, batch: str) -> None:
    """Notes which topic-hours a batch landed, below ``path/hours``.

    The files are listed, not read, so the publisher learns what changed without
    another pass over the data.
    """
    for kind in KINDS:
        landed = batch_folder(f"{path}/{kind}", run, batch)
        if exists(spark, landed):
            hours = hours_of_files(list_files(spark, landed, "part-*"))
            hours.coalesce(1).write.mode("overwrite").parquet(batch_folder(f"{path}/hours/{kind}", run, batch))


def landed_text(spark: SparkSession, path: str, batches: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Lines landed by ``land_by_codec`` with their topic, hour, run and batch; of all batches, or only of the given ones."""
    full = StructType([StructField("value", StringType()), *_PLACE])
    return _landed(spark, f"{path}/text", batches, full, "text")


def landed_parquet(spark: SparkSession, path: str, schema: StructType, batches: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    full = StructType([*schema.fields, *_PLACE])
    return _landed(spark, f"{path}/parquet", batches, full, "parquet")


def landed_tables(spark: SparkSession, path: str, schemas: Mapping[str, StructType], batches: Sequence[tuple[str, str]] | None = None) -> dict[str, DataFrame]:
    """Rows landed by their topics' schemas, a table for each fingerprint; only the folders of that schema are read."""
    found = {}
    for fingerprint, (schema, _) in schema_groups(schemas).items():
        full = StructType([*schema.fields, StructField("schema_id", StringType()), *_PLACE])
        found[fingerprint] = _landed(spark, f"{path}/tables", batches, full, "parquet").filter(F.col("schema_id") == fingerprint).drop("schema_id")
    return found


def _landed(spark: SparkSession, root: str, batches: Sequence[tuple[str, str]] | None, schema: StructType, fmt: str) -> DataFrame:
    folders = [root] if batches is None else [batch_folder(root, *b) for b in batches]
    present = [f for f in folders if exists(spark, f)]
    if not present:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).option("basePath", root).load(present).select(*schema.names)


def message_bytes(message: Column) -> Column:
    """A message as it is written: its UTF-8 bytes and a newline."""
    return F.encode(F.concat(message, F.lit("\n")), "UTF-8")
