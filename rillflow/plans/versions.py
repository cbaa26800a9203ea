"""Publishing by manifest: increments that are seen at once, and compaction of their small files.

An increment is written once, by Spark's own commit, into a folder of its own
below its base. What readers see is the manifest, a small Parquet table of
files by place (the lake directory they belong to). An increment's part of it is
moved in by one rename of a folder, so all of its files are seen or none,
wherever they lie and whenever the publisher stops. An increment that runs
again is a new attempt: readers take the newest attempt of each publication, so
rows whose destination has moved are gone from the old one with the same rename.

Compaction joins the small files of a place and adds what it wrote to the
manifest, with the attempts it read and the files it stands for. It counts as
long as these attempts are the newest ones; when one was published again
meanwhile, or is later, readers fall back to the files themselves. Publishers
and a compaction therefore need no lock: late increments are other files and
stay. Of two compactions that read the same files the second to commit is given
up. ``remove_unseen`` deletes what no reader needs; it and compactions are run
by one job.

Only names pass the driver: one publication, the bases, the files to be read.
The manifest needs a store that renames a folder at once.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow.functions.keys import strip_last_slash
from rillflow.operators.catalog import PublishDefaults
from rillflow.operators.lookup import lookup_join
from rillflow.operators.tables import add_partitions, set_locations
from rillflow.plans.publish import PARALLEL_WRITES, publish_settings
from rillflow.session import ROLLOVER_BYTES
from rillflow.sinks.landing import gather
from rillflow.sources.files import list_files
from rillflow.sources.store import exists, make_folder, move, names_in, remove

MANIFEST_SCHEMA = (
    "place string, base string, path string, length bigint, "
    "sources array<struct<publication:string,attempt:string>>, replaces array<string>"
)
FILES = "_increments"
_NAME = re.compile(r"[A-Za-z0-9._-]+")
_OWN_PATH = rf"/{FILES}/([^/]+/key=[0-9a-f]+/[^/]+)$"


@dataclass(frozen=True)
class Written:
    """Files of an increment or a compaction that are on the store and not yet in the manifest."""

    spark: SparkSession
    log: str
    publication: str
    attempt: str
    entries: str
    joined: str | None = None


def own_path(path: Column) -> Column:
    """A published file's name from its increment's folder on: made of plain letters, the same in listings and in metadata."""
    return F.regexp_extract(path, _OWN_PATH, 1)


def manifest(spark: SparkSession, log: str) -> DataFrame:
    """All entries ever committed, with ``publication`` and ``attempt``; an entry without a path only says that there was one."""
    schema = StructType.fromDDL(f"{MANIFEST_SCHEMA}, publication string, attempt string")
    if not exists(spark, f"{log}/manifest"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{log}/manifest")


def _newest(entries: DataFrame) -> DataFrame:
    return entries.groupBy("publication").agg(F.max("attempt").alias("newest"))


def _layers(spark: SparkSession, log: str) -> tuple[DataFrame, DataFrame]:
    """Entries of the newest attempts: the published files, and the compacted ones whose sources are all newest."""
    entries = manifest(spark, log)
    newest = _newest(entries)
    current = entries.join(newest, "publication").where((F.col("attempt") == F.col("newest")) & F.col("path").isNotNull()).drop("newest")
    compacted = current.where(F.size("sources") > 0)
    read = compacted.select("path", F.explode("sources").alias("s")).select("path", "s.publication", F.col("s.attempt").alias("read"))
    outdated = read.join(newest, "publication", "left").where(~F.col("read").eqNullSafe(F.col("newest"))).select("path").distinct()
    return current.where(F.size("sources") == 0), compacted.join(outdated, "path", "left_anti")


def live_files(spark: SparkSession, log: str) -> DataFrame:
    """What a reader sees: ``place, base, path, length, sources, replaces, publication, attempt`` of each file."""
    published, compacted = _layers(spark, log)
    replaced = compacted.select(F.explode("replaces").alias("path")).distinct()
    return published.unionByName(compacted).join(replaced, "path", "left_anti")


def read_published(spark: SparkSession, log: str, fmt: str = "text", schema: StructType | str = "value string") -> DataFrame:
    """The rows that are published, with their ``place``."""
    files = live_files(spark, log).select("path", "place").collect()
    return _rows_of(spark, [(r["path"], r["place"]) for r in files], fmt, schema).withColumnRenamed("_of", "place")


def _rows_of(spark: SparkSession, files: list[tuple[str, str]], fmt: str, schema: StructType | str) -> DataFrame:
    """The rows of named files, with what is given for each as ``_of``."""
    wanted = spark.createDataFrame(files, "path string, _of string").select(own_path(F.col("path")).alias("_own"), "_of")
    if not files:
        return spark.createDataFrame([], schema).withColumn("_of", F.lit(None).cast("string"))
    rows = spark.read.format(fmt).schema(schema).load([path for path, _ in files])
    return lookup_join(rows.withColumn("_path", own_path(F.col("_metadata.file_path"))), wanted, "_path", "_own", how="inner").drop("_path")


def _write(rows: DataFrame, base: str, name: str, fmt: str, codec: str) -> DataFrame:
    """``rows`` with ``key`` below ``base``; returns ``base, key, path, length`` of the files."""
    spark, folder = rows.sparkSession, f"{base}/{FILES}/{name}"
    rows.write.partitionBy("key").option("compression", codec).format(fmt).save(folder)
    files = list_files(spark, folder, "part-*")
    return files.select(F.lit(base).alias("base"), F.regexp_extract("path", "/key=([0-9a-f]+)/", 1).alias("key"), "path", "length")


def _stage_entries(entries: DataFrame, log: str) -> str:
    """Entries written beside the manifest, and one without a path, so that an attempt without files is one too."""
    spark, path = entries.sparkSession, f"{log}/_staged/{uuid.uuid4().hex}"
    fields = StructType.fromDDL(MANIFEST_SCHEMA)
    none = spark.createDataFrame([(None,) * len(fields)], fields)
    entries.select(*[F.col(f.name).cast(f.dataType) for f in fields]).unionByName(none).coalesce(1).write.parquet(path)
    return path


def commit(written: Written) -> bool:
    """One rename: from now on readers see the files.

    A compaction is given up, and the answer is no, when a file that it read is no longer seen.
    """
    spark = written.spark
    if written.joined and not spark.read.parquet(written.joined).join(live_files(spark, written.log), "path", "left_anti").isEmpty():
        return False
    folder = f"{written.log}/manifest/publication={written.publication}"
    make_folder(spark, folder)
    move(spark, written.entries, f"{folder}/attempt={written.attempt}")
    return True


def _next_attempt(spark: SparkSession, log: str, publication: str) -> str:
    """Higher than all before; of two publishers that take the same number one wins, whichever, as a whole."""
    before = [int(n[8:].split(".")[0]) for n in names_in(spark, f"{log}/manifest/publication={publication}") if n.startswith("attempt=")]
    return f"{max(before, default=-1) + 1:06d}.{uuid.uuid4().hex}"


def _may_run_again(spark: SparkSession, log: str, publication: str) -> None:
    """A publication may be replaced while the files that were compacted with it are still there to fall back to."""
    if not exists(spark, f"{log}/manifest/publication={publication}"):
        return
    _, compacted = _layers(spark, log)
    mine = compacted.where(F.exists("sources", lambda s: s["publication"] == publication))
    folder = F.regexp_extract("f", rf"^(.*/{FILES}/[^/]+)/", 1)
    for row in mine.select(F.explode("replaces").alias("f")).select(folder.alias("folder")).distinct().toLocalIterator():
        if not exists(spark, row["folder"]):
            raise ValueError(f"{publication} is compacted and the files before it are removed: it cannot be published again")


def write_increment(
    rows: DataFrame, hours: DataFrame, catalog: DataFrame, log: str, publication: str, defaults: PublishDefaults = PublishDefaults(),
    fmt: str = "text", codec: str = "gzip", writers: int | None = None,
) -> Written:
    """Writes rows (``topic, hour`` and data columns) of the topic-hours ``hours`` for their places; nothing is seen yet.

    Rows of topic-hours with a bad name are not written. There is one write for each base.
    """
    if not _NAME.fullmatch(publication):
        raise ValueError(f"{publication!r} cannot name a publication")
    spark = rows.sparkSession
    _may_run_again(spark, log, publication)
    attempt = _next_attempt(spark, log, publication)
    name = f"{publication}.{attempt}"
    settings = publish_settings(hours.select("topic", "hour").distinct(), catalog, defaults).where("NOT bad_name")
    key = F.concat_ws("\0", "topic", "hour")
    places = settings.select(
        key.alias("_place_key"), F.col("dir").alias("place"), F.md5(F.col("dir").cast("binary")).alias("key"), strip_last_slash(F.col("base_partition")).alias("base")
    ).persist()
    try:
        keyed = rows.withColumn("_key", key)

        def write(base: str) -> DataFrame:
            mine = lookup_join(keyed, places.where(F.col("base") == base).select("_place_key", "key"), "_key", "_place_key", how="inner").drop("_key", "topic", "hour")
            return _write(gather(mine, ("key",), writers), base, name, fmt, codec)

        with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
            bases = [r["base"] for r in places.select("base").distinct().toLocalIterator()]
            parts = list(pool.map(inheritable_thread_target(spark)(write), bases))
        nothing = F.array()
        entries = spark.createDataFrame([], MANIFEST_SCHEMA)
        for files in parts:
            named = lookup_join(files, places.select(F.col("key").alias("_named"), "place").distinct(), "key", "_named", how="inner")
            entries = entries.unionByName(named.select("place", "base", "path", "length", nothing.alias("sources"), nothing.alias("replaces")))
        return Written(spark, log, publication, attempt, _stage_entries(entries, log))
    finally:
        places.unpersist()


def publish_increment(rows: DataFrame, hours: DataFrame, catalog: DataFrame, log: str, publication: str, defaults: PublishDefaults = PublishDefaults(), **options) -> None:
    """Adds rows to the lake under a name, at once; the same name again replaces them, wherever they lie."""
    commit(write_increment(rows, hours, catalog, log, publication, defaults, **options))


def write_compaction(
    spark: SparkSession, log: str, target_bytes: int = ROLLOVER_BYTES, whole: bool = False, fmt: str = "text", schema: StructType | str = "value string", codec: str = "gzip",
) -> Written | None:
    """Joins the files of each place that are smaller than the target into as few as their bytes need; nothing is seen yet.

    A place of b such bytes gets ceil(b / target) files, packed by their lengths
    from the listing; places that have no more than that are left alone. With
    ``whole`` larger files take part, so that a closed hour lies in one folder.
    Returns None when there is nothing to join.
    """
    live = live_files(spark, log)
    chosen = live if whole else live.where(F.col("length") < target_bytes)
    place = Window.partitionBy("place")
    before = F.sum("length").over(place.orderBy(F.desc("length"), "path").rowsBetween(Window.unboundedPreceding, -1))
    total = F.greatest(F.sum("length").over(place), F.lit(1))
    bins = F.ceil(total / F.lit(target_bytes))
    folders = F.size(F.collect_set(F.regexp_extract("path", "^(.*)/[^/]*$", 1)).over(place))
    packed = chosen.withColumns({"bins": bins, "files": F.count("*").over(place), "folders": folders, "bin": F.floor(F.coalesce(before, F.lit(0)) * bins / total).cast("int")})
    worth = F.col("files") > F.col("bins")
    packed = packed.where(worth | (F.col("folders") > 1) if whole else worth)
    packed = packed.withColumn("key", F.md5(F.col("place").cast("binary"))).persist()
    try:
        publication, attempt = f"compaction-{uuid.uuid4().hex}", "000000"
        name = f"{publication}.{attempt}"

        def write(base: str) -> DataFrame:
            mine = packed.where(F.col("base") == base)
            files = [(r["path"], r["key"], r["bin"]) for r in mine.select("path", "key", "bin").toLocalIterator()]
            numbers = {b: i for i, b in enumerate(sorted({(key, bin) for _, key, bin in files}))}
            rows = _rows_of(spark, [(path, f"{key}/{numbers[key, bin]}") for path, key, bin in files], fmt, schema)
            dealt = rows.withColumns({"key": F.split_part("_of", F.lit("/"), F.lit(1)), "_bin": F.split_part("_of", F.lit("/"), F.lit(2)).cast("int")})
            # A task for each bin, so that a bin is a file.
            return _write(dealt.repartitionById(len(numbers), F.col("_bin")).drop("_of", "_bin"), base, name, fmt, codec)

        with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
            bases = [r["base"] for r in packed.select("base").distinct().toLocalIterator()]
            parts = list(pool.map(inheritable_thread_target(spark)(write), bases))
        if not parts:
            return None
        own = F.when(F.size("sources") > 0, F.col("sources")).otherwise(F.array(F.struct("publication", "attempt")))
        stands = packed.groupBy("key", "place", "base").agg(
            F.array_distinct(F.flatten(F.collect_set(own))).alias("sources"),
            F.array_distinct(F.concat(F.collect_list("path"), F.flatten(F.collect_list("replaces")))).alias("replaces"),
        )
        written = parts[0]
        for more in parts[1:]:
            written = written.unionByName(more)
        entries = _stage_entries(written.join(stands, ["key", "base"]), log)
        joined = f"{entries}-joined"
        packed.select("path").write.parquet(joined)
        return Written(spark, log, publication, attempt, entries, joined)
    finally:
        packed.unpersist()


def compact(spark: SparkSession, log: str, target_bytes: int = ROLLOVER_BYTES, **options) -> bool:
    """Joins small files; whether there were any. Readers see the joined files instead of theirs at once."""
    written = write_compaction(spark, log, target_bytes, **options)
    return written is not None and commit(written)


def remove_unseen(spark: SparkSession, log: str, unfinished: bool = False) -> int:
    """Deletes the folders of increments of which no file is seen any more; returns how many.

    With ``unfinished`` also those that no manifest names: only for times at which nothing is being published.
    """
    folder = F.regexp_extract("path", rf"^(.*/{FILES}/[^/]+)/", 1).alias("folder")
    known = manifest(spark, log).where("path IS NOT NULL")
    live = live_files(spark, log).select(folder).distinct()
    # Deleting what joined files stand for closes the publications in them: see ``_may_run_again``.
    unseen = [r["folder"] for r in known.select(folder).distinct().join(live, "folder", "left_anti").toLocalIterator()]
    if unfinished:
        named = {r["folder"] for r in known.select(folder).distinct().toLocalIterator()}
        for row in known.select("base").distinct().toLocalIterator():
            root = f"{row['base']}/{FILES}"
            tails = {n.rsplit("/", 1)[1] for n in named}
            unseen += [f"{root}/{n}" for n in names_in(spark, root) if n not in tails]
    present = [f for f in dict.fromkeys(unseen) if exists(spark, f)]
    for path in present:
        remove(spark, path)
    return len(present)


def switch_partitions(spark: SparkSession, log: str, settings: DataFrame, **retry) -> DataFrame:
    """Tables of topics with a Hive URL get each published hour at the folder where its files are.

    An hour whose files lie in several folders waits for a compaction of the
    whole. A partition that is there already is switched by its location, so its
    readers see the old files or the new. Returns ``log, dt, hr, status``:
    ``ok``, ``waits`` or the failure.
    """
    folders = live_files(spark, log).groupBy("place").agg(F.collect_set(F.regexp_extract("path", "^(.*)/[^/]*$", 1)).alias("folders"))
    wanted = settings.where((F.coalesce(F.col("hive_url"), F.lit("")) != "") & ~F.col("bad_name"))
    rows = wanted.join(folders, wanted["dir"] == folders["place"]).select("topic", "hive_db_name", "hive_table_name", "dt", "hr", "folders").distinct()
    by_table: dict[str, list] = {}
    told = []
    for r in rows.toLocalIterator():
        if len(r["folders"]) > 1:
            told.append((r["topic"], r["dt"], r["hr"], "waits"))
        else:
            by_table.setdefault(f"`{r['hive_db_name']}`.`{r['hive_table_name']}`", []).append(r)
    for table, own in sorted(by_table.items()):
        places = sorted({(r["dt"], r["hr"], r["folders"][0]) for r in own})
        failure = add_partitions(spark, table, places, **retry) or set_locations(spark, table, places, **retry)
        told += [(r["topic"], r["dt"], r["hr"], failure or "ok") for r in own]
    return spark.createDataFrame(told, "log string, dt string, hr string, status string")
