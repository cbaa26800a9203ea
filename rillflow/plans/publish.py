"""Publish: landed hours to the lake, with partitions registered for good rows.

Publishing adds increments: each landed batch once, in files of its own name. A
publish that runs twice replaces only its own files; late rows are added to
their hour; topics and layouts that share a directory never touch each other's
files. So a round reads what is new, however much the lake holds.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow.functions.keys import file_hour, file_topic, hour_dir, lake_dir, parse_hour_key, strip_last_slash
from rillflow.operators.catalog import PublishDefaults, with_publish_settings
from rillflow.operators.lookup import lookup_join
from rillflow.operators.tables import add_partitions
from rillflow.sinks.landing import batch_folder, gather, landed_parquet, landed_text
from rillflow.sinks.reports import partition_audit
from rillflow.sources.store import files_below, make_folder, move, move_file, names_in, remove

# Base folders written, and files renamed, at the same time.
PARALLEL_WRITES = 4
PARALLEL_MOVES = 16


def rows_of_named_files(lines: DataFrame) -> DataFrame:
    """Rows of files named ``topic-yyyy-MM-dd-HH...`` with topic and hour of the name.

    ``lines`` hold a ``file`` column. Rows of other files have no topic or hour.
    """
    return lines.withColumns({"topic": file_topic(F.col("file")), "hour": file_hour(F.col("file"))}).drop("file")


def publish_settings(hours: DataFrame, catalog: DataFrame, defaults: PublishDefaults = PublishDefaults()) -> DataFrame:
    """Topic-hours with destination, table and lake directory.

    ``bad_name`` marks hours whose topic or hour is unusable.
    """
    settings = with_publish_settings(hours, catalog, "topic", defaults)
    ts = parse_hour_key(F.col("hour"))
    directory = lake_dir(F.col("base_partition"), F.col("log_partition"), F.col("date_format"), ts)
    return settings.withColumns({
        "dir": directory,
        "dt": F.date_format(ts, "yyyyMMdd"),
        "hr": hour_dir(ts),
        "bad_name": directory.isNull(),
    })


def publish_rows(
    rows: DataFrame,
    hours: DataFrame,
    catalog: DataFrame,
    defaults: PublishDefaults = PublishDefaults(),
    fmt: str = "text",
    codec: str = "gzip",
    writers: int | None = None,
) -> DataFrame:
    """Add rows to the lake, once.

    ``rows`` hold ``topic, hour, publication`` and data columns; ``hours`` their
    topic-hours. A publication is the name of an increment, safe in a file name.
    Its rows are written beside the lake, in one write for each base folder, and
    the finished files are moved to their directories under the publication's
    name. A publication that runs again first removes the files of its own
    name, and no other file is ever touched: late rows, other topics of a
    directory and earlier increments stay. Returns the settings of the hours
    published, kept so that what is registered is what was written; the caller
    unpersists them.
    """
    spark = rows.sparkSession
    settings = publish_settings(hours.select("topic", "hour").distinct(), catalog, defaults).persist(StorageLevel.MEMORY_AND_DISK)
    usable = settings.filter(~F.col("bad_name")).withColumn("_base", strip_last_slash(F.col("base_partition")))
    key = F.concat_ws("\0", "topic", "hour")
    keyed = rows.withColumn("_key", key)

    def write(base: str) -> None:
        places = usable.filter(F.col("_base") == base).select(key.alias("_place_key"), "dir").distinct()
        mine = lookup_join(keyed, places, "_key", "_place_key", how="inner").drop("_key", "topic", "hour")
        staged = f"{base}/_publishing/{uuid.uuid4().hex}"
        parts = gather(mine, ("dir", "publication"), writers)
        parts.write.partitionBy("dir", "publication").option("compression", codec).format(fmt).save(staged)
        _move_into_place(spark, staged)
        remove(spark, staged)

    # Bases are independent jobs; several at once keep the cluster busy while one commits.
    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        bases = [r["_base"] for r in usable.select("_base").distinct().toLocalIterator()]
        for _ in pool.map(inheritable_thread_target(spark)(write), bases):
            pass
    return settings


_STAGED = re.compile(r"/dir=([^/]*)/publication=([^/]*)/(part-[^/]*)$")


def _move_into_place(spark: SparkSession, staged: str) -> None:
    """Renames the finished files of a staged write; file names, never rows, pass the driver."""
    moves: dict[str, list[tuple[str, str]]] = {}
    for path, _ in files_below(spark, staged):
        if found := _STAGED.search(path):
            directory, publication, name = map(unquote, found.groups())
            moves.setdefault(directory, []).append((path, f"{publication}-{name}"))

    def place(directory: str) -> None:
        make_folder(spark, directory)
        own = tuple({name.partition("-part-")[0] + "-part-" for _, name in moves[directory]})
        for name in names_in(spark, directory):
            if name.startswith(own):
                remove(spark, f"{directory}/{name}")
        for path, name in moves[directory]:
            move(spark, path, f"{directory}/{name}")

    with ThreadPoolExecutor(PARALLEL_MOVES) as pool:
        for _ in pool.map(place, moves):
            pass


def landed_batches(spark: SparkSession, landing: str, kind: str = "text") -> list[tuple[str, str]]:
    """Run and batch of what was landed and not yet published, from the folders of their notes."""
    noted, done = (_batch_folders(spark, f"{landing}/{name}/{kind}") for name in ("hours", "published"))
    return sorted(noted - done)


def _batch_folders(spark: SparkSession, root: str) -> set[tuple[str, str]]:
    runs = [n for n in names_in(spark, root) if n.startswith("run=")]
    return {(r[4:], b[6:]) for r in runs for b in names_in(spark, f"{root}/{r}") if b.startswith("batch=")}


def publish_batches(
    spark: SparkSession,
    landing: str,
    batches: Sequence[tuple[str, str]],
    catalog: DataFrame,
    defaults: PublishDefaults = PublishDefaults(),
    schema: StructType | None = None,
    codec: str = "gzip",
    writers: int | None = None,
) -> DataFrame:
    """Publish landed batches, each under its own name, and note that they are.

    Only the folders of these batches are read. With a ``schema`` their Parquet
    rows are published, else their text.
    """
    kind = "text" if schema is None else "parquet"
    landed = landed_text(spark, landing, batches) if schema is None else landed_parquet(spark, landing, schema, batches)
    rows = landed.withColumn("publication", F.concat_ws(".", "run", "batch")).drop("run", "batch")
    notes = [batch_folder(f"{landing}/hours/{kind}", *b) for b in batches]
    hours = spark.read.schema("topic string, hour string").parquet(*notes) if notes else spark.createDataFrame([], "topic string, hour string")
    settings = publish_rows(rows, hours, catalog, defaults, kind, codec, writers)
    for batch in batches:
        make_folder(spark, batch_folder(f"{landing}/published/{kind}", *batch))
    return settings


def remove_published(spark: SparkSession, landing: str, kind: str = "text") -> int:
    """Removes landed batches that were published, with their notes; returns how many."""
    done = _batch_folders(spark, f"{landing}/published/{kind}")
    for batch in sorted(done):
        for root in (f"{landing}/{kind}", f"{landing}/hours/{kind}", f"{landing}/published/{kind}"):
            remove(spark, batch_folder(root, *batch))
    return len(done)


def quarantine_files(spark: SparkSession, checked: DataFrame, catalog: DataFrame, defaults: PublishDefaults = PublishDefaults(), label: str = "found") -> DataFrame:
    """Moves corrupt files, as they are, into the lake layout below their topic's quarantine folder.

    ``checked`` holds ``path, length, file_ok``. A file keeps its name, in a folder
    named after ``label`` and the folder that it came from, so files of one name
    stay apart; one without an hour in its name lies below ``unnamed``. Names
    alone pass the driver, the store moves the bytes. The same call again goes on
    where it stopped. Returns ``path, target, length``.
    """
    bad = checked.filter(~F.col("file_ok")).select(
        "path", "length", file_topic(F.col("path")).alias("topic"), file_hour(F.col("path")).alias("hour")
    )
    settings = publish_settings(bad, catalog, defaults)
    quarantine = strip_last_slash(F.col("quarantine"))
    place = F.coalesce(lake_dir(quarantine, F.col("log_partition"), F.col("date_format"), parse_hour_key(F.col("hour"))), F.concat(quarantine, F.lit("/unnamed")))
    source = F.md5(F.regexp_replace("path", "/[^/]*$", "").cast("binary"))
    target = F.concat(place, F.lit(f"/{label}-"), source, F.lit("/"), F.substring_index("path", "/", -1))
    moves = [(r["path"], r["target"], r["length"]) for r in settings.select("path", target.alias("target"), "length").toLocalIterator()]
    with ThreadPoolExecutor(PARALLEL_MOVES) as pool:
        for _ in pool.map(lambda m: move_file(spark, m[0], m[1]), moves):
            pass
    return spark.createDataFrame(moves, "path string, target string, length bigint")


def register_partitions(spark: SparkSession, settings: DataFrame, **retry) -> DataFrame:
    """Register the published directories with the tables of topics that have a
    Hive URL; returns an audit row for each (``log, partition, status, exception``).

    Daily topics get a day-hour partition per hour too, at their day's directory.
    A table that refuses its partitions is reported and the others go on.
    """
    wanted = settings.filter(~F.col("bad_name") & (F.coalesce(F.col("hive_url"), F.lit("")) != ""))
    by_table: dict[str, list] = {}
    for row in wanted.select("topic", "hive_db_name", "hive_table_name", "dt", "hr", "dir").distinct().toLocalIterator():
        by_table.setdefault(f"`{row['hive_db_name']}`.`{row['hive_table_name']}`", []).append(row)
    told = []
    for table, rows in sorted(by_table.items()):
        places = sorted({(r["dt"], r["hr"], r["dir"]) for r in rows})
        failure = add_partitions(spark, table, places, **retry)
        told += [(r["topic"], r["dt"], r["hr"], failure) for r in rows]
    partitions = spark.createDataFrame(told, "topic string, dt string, hr string, failure string")
    return partition_audit(partitions, F.col("failure"))
