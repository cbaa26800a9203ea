"""Finished files: listing, integrity, and reading their lines back."""

from __future__ import annotations

import io
import re
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from rillflow.functions.keys import base_name
from rillflow.operators.lookup import lookup_join
from rillflow.sources.store import empty_below, footer_ok

# Extensions of finished files, how long a file must rest before it
# counts as finished, and the folder of copies in progress.
FINISHED_GLOB = "*.{gz,parquet}"
FINISHED_NAME = r"\.(gz|parquet)$"
FILE_WAIT_MS = 30_000
COPYING_FOLDER = "/tmp/copying"

# A Parquet file without rows is its footer alone; one larger than this is not read as a cell.
FOOTER_BYTES = 64 << 20

RAW_MESSAGE_SCHEMA = StructType([StructField("topic", StringType()), StructField("value", StringType())])


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path, modificationTime, length`` of every file below ``path``. No file is opened.

    Spark's file sources leave out files of zero bytes: see ``empty_files``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "modificationTime", "length")


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of zero bytes below ``path``, in the columns of ``list_files``; their listing alone passes the driver."""
    found = [(name, when, 0) for name, when in empty_below(spark, path)]
    listed = spark.createDataFrame(found, "path string, at bigint, length bigint")
    return listed.select("path", F.timestamp_millis("at").alias("modificationTime"), "length")


def is_finished(files: DataFrame, wait_ms: int = FILE_WAIT_MS, now: datetime | None = None) -> DataFrame:
    """Files with a finished name that rested long enough and are not copies in progress."""
    now = now or datetime.now(timezone.utc)
    before = F.lit(now - timedelta(milliseconds=wait_ms))
    return files.filter(
        base_name(F.col("path")).rlike(FINISHED_NAME)
        & (F.col("modificationTime") < before)
        & ~F.col("path").contains(COPYING_FOLDER)
    )


def finished_files(spark: SparkSession, path: str, wait_ms: int = FILE_WAIT_MS, now: datetime | None = None) -> DataFrame:
    return is_finished(list_files(spark, path, FINISHED_GLOB).unionByName(empty_files(spark, path)), wait_ms, now)


def plain_path(path: Column) -> Column:
    """The path of a row's metadata, as listings write it."""
    # A plus sign is itself there, which URL decoding would turn into a space.
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def literal_path(path: str) -> str:
    """A path for a reader that would take some characters for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def check_files(files: DataFrame, root: str) -> DataFrame:
    """Adds ``file_ok`` to a listing of files below ``root``: Parquet files must have a readable footer, others pass.

    One scan of the folder reads the footers, in tasks, on whatever store the
    files are, and is joined with the listing: a file from which it gets a row is
    sound. Of the few others, broken or without rows, the names pass the driver
    and tasks read the bytes; only what is no Parquet file counts as corrupt, a
    store that fails is an error and no verdict. Those above ``FOOTER_BYTES`` are
    opened one by one through Hadoop.
    """
    spark = files.sparkSession
    is_parquet = F.col("path").endswith(".parquet")
    scan = spark.read.schema(StructType([])).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    found = scan.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).parquet(root)
    with_rows = found.select(plain_path(F.col("_metadata.file_path")).alias("path")).distinct()
    doubtful = files.filter(is_parquet & (F.col("length") > 0)).join(with_rows, "path", "left_anti")
    small, sound = [], []
    for row in doubtful.select("path", "length").toLocalIterator():
        if row["length"] <= FOOTER_BYTES:
            small.append(row["path"])
        elif footer_ok(spark, row["path"]):
            sound.append((row["path"],))
    known = with_rows.unionByName(spark.createDataFrame(sound, "path string"))
    if small:
        content = spark.read.format("binaryFile").load([literal_path(p) for p in small])
        known = known.unionByName(content.filter(_is_parquet("content")).select("path"))
    known = known.select(F.col("path").alias("_known_path"), F.lit(True).alias("_sound"))
    checked = lookup_join(files, known, "path", "_known_path")
    return checked.withColumn("file_ok", ~is_parquet | F.col("_sound").isNotNull()).drop("_sound")


@F.pandas_udf(BooleanType())
def _is_parquet(content: pd.Series) -> pd.Series:
    import pyarrow
    from pyarrow import parquet

    def opens(data: bytes) -> bool:
        try:
            parquet.read_metadata(io.BytesIO(data))
            return True
        except (pyarrow.ArrowException, OSError):
            # The bytes are in memory: nothing but they can be at fault.
            return False

    return content.map(opens)


def read_finished_text(spark: SparkSession, path: str, wait_ms: int = FILE_WAIT_MS) -> DataFrame:
    """Lines of finished text files, with the file they come from."""
    before = datetime.now(timezone.utc) - timedelta(milliseconds=wait_ms)
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.gz")
        .option("modifiedBefore", before.strftime("%Y-%m-%dT%H:%M:%S"))
        .option("timeZone", "UTC")
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"))
    )


def read_finished_parquet(spark: SparkSession, path: str, schema: StructType | None = None, wait_ms: int = FILE_WAIT_MS) -> DataFrame:
    before = datetime.now(timezone.utc) - timedelta(milliseconds=wait_ms)
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("modifiedBefore", before.strftime("%Y-%m-%dT%H:%M:%S"))
        .option("timeZone", "UTC")
    )
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    return df.select("*", F.col("_metadata.file_path").alias("file"))


def read_landed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every landed line below ``path``, whatever its compression. Names ending in a
    number are files still being written and are left out."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    return lines.filter(~F.col("_metadata.file_name").rlike(r"\.[0-9]+$")).select("value")


def stream_messages(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """A stream of raw messages from files, in place of a broker."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
