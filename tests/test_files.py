import gzip
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow.functions import keys
from rillflow.operators import metrics, tables
from rillflow.operators.catalog import PublishDefaults, make_catalog
from rillflow.plans.publish import landed_batches, publish_batches, publish_rows, publish_settings, quarantine_files, register_partitions, remove_published, rows_of_named_files
from rillflow.sinks import lake, landing, reports
from rillflow.sources import files, generator


def messages(spark, n, topic="test"):
    return spark.range(n).select(
        F.lit(topic).alias("topic"), F.lit("2016-03-20-09").alias("hour"), F.lit("ping").alias("message"), F.lit("none").alias("codec")
    )


def test_lines_of_two_writes(spark, tmp_path):
    for _ in range(2):
        landing.land_text(messages(spark, 700), f"{tmp_path}/out", codec="none", max_records=50, writers=2)
    lines = files.read_landed_lines(spark, f"{tmp_path}/out")
    assert lines.count() == 1400 and lines.distinct().collect()[0]["value"] == "ping"
    counts = [r["messages"] for r in metrics.messages_per_file(spark.read.text(f"{tmp_path}/out")).collect()]
    assert sum(counts) == 1400 and max(counts) <= 50


@pytest.mark.parametrize("codec,ending", [("none", ".txt"), ("gzip", ".gz"), ("snappy", ".snappy"), ("bzip2", ".bz2")])
def test_text_codecs(spark, tmp_path, codec, ending):
    landing.land_text(messages(spark, 10), f"{tmp_path}/out", codec=codec)
    names = [r["path"] for r in files.list_files(spark, f"{tmp_path}/out", "part-*").collect()]
    assert names and all(n.endswith(ending) for n in names)
    assert files.read_landed_lines(spark, f"{tmp_path}/out").count() == 10


def test_rows_without_key_are_not_landed(spark, tmp_path):
    rows = messages(spark, 4).withColumn("n", F.monotonically_increasing_id())
    rows = spark.createDataFrame([("a", None, "m"), (None, "2016-03-20-09", "m"), ("a", "2016-03-20-09", "m")], "topic string, hour string, message string")
    landing.land_text(rows, f"{tmp_path}/out")
    assert files.read_landed_lines(spark, f"{tmp_path}/out").count() == 1


def test_temporary_names_are_skipped(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "t-2016-03-20-09.gz").write_bytes(gzip.compress(b"one\ntwo\n"))
    (tmp_path / "a" / "t-2016-03-20-09.gz.1").write_text("three\n")
    assert sorted(r["value"] for r in files.read_landed_lines(spark, str(tmp_path)).collect()) == ["one", "two"]


def test_finished_files_and_integrity(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/p")
    good = next(n for n in os.listdir(tmp_path / "p") if n.endswith(".parquet"))
    os.rename(tmp_path / "p" / good, tmp_path / "t %41-2016-03-20-09.parquet")
    (tmp_path / "bad-2016-03-20-09.parquet").write_bytes(b"PAR1 not a footer")
    (tmp_path / "empty-2016-03-20-09.parquet").write_bytes(b"")
    (tmp_path / "t-2016-03-20-09.gz").write_bytes(gzip.compress(b"x\n"))
    (tmp_path / "t-2016-03-20-09.gz.tmp").write_text("x")
    old = time.time() - 60
    for name in os.listdir(tmp_path):
        os.utime(tmp_path / name, (old, old))
    (tmp_path / "young-2016-03-20-09.gz").write_bytes(gzip.compress(b"y\n"))
    found = files.check_files(files.finished_files(spark, str(tmp_path)), str(tmp_path))
    got = {r["path"].rsplit("/", 1)[1]: r["file_ok"] for r in found.collect()}
    assert got == {
        "t %41-2016-03-20-09.parquet": True, "bad-2016-03-20-09.parquet": False, "t-2016-03-20-09.gz": True, "empty-2016-03-20-09.parquet": False,
    }
    assert [r["value"] for r in files.read_finished_text(spark, str(tmp_path)).collect()] == ["x"]
    meters = metrics.file_meters(found).first()
    assert meters["files"] == 4 and meters["bytes"] > 0


def test_destination_of_files(spark):
    df = spark.createDataFrame([("hits-2021-07-04-18.gz",), ("clicks-2021-07-04-18.77.gz",), ("two-part-2021-12-31-00.gz",), ("x.gz",)], "f string")
    got = df.select(
        keys.file_topic(F.col("f")), keys.file_hour(F.col("f")),
        keys.destination_path(F.lit("/log/base/"), keys.file_topic(F.col("f")), F.lit("datehour"), F.lit("h"), F.col("f")),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("hits", "2021-07-04-18", "/log/base/hits/date=20210704/hour=2021070418/h-hits-2021-07-04-18.gz"),
        ("clicks", "2021-07-04-18", "/log/base/clicks/date=20210704/hour=2021070418/h-clicks-2021-07-04-18.77.gz"),
        ("two-part", "2021-12-31-00", "/log/base/two-part/date=20211231/hour=2021123100/h-two-part-2021-12-31-00.gz"),
        (None, None, None),
    ]


def test_publication_replaces_only_itself(spark, tmp_path):
    rows = spark.createDataFrame(
        [("v1", "test", "2016-03-20-09"), ("v2", "test", "2016-03-20-10"), ("d", "daily", "2016-03-20-09"), ("n", "test", "notime")],
        "value string, topic string, hour string",
    )
    catalog = make_catalog(spark, [{"log": "daily", "base_partition": f"{tmp_path}/lake", "log_partition": "daily", "date_format": "date", "quarantine": f"{tmp_path}/q"}])
    defaults = PublishDefaults(base_partition=f"{tmp_path}/lake", quarantine=f"{tmp_path}/q")
    hours = rows.select("topic", "hour")
    assert [r["hour"] for r in publish_settings(hours, catalog, defaults).filter("bad_name").collect()] == ["notime"]
    publish_rows(rows.withColumn("publication", F.lit("one")), hours, catalog, defaults)
    late = rows.filter("value = 'v2'").withColumn("value", F.lit("late")).withColumn("publication", F.lit("two"))
    for _ in range(2):
        publish_rows(late, late.select("topic", "hour"), catalog, defaults)
    got = lake.read_lake(spark, f"{tmp_path}/lake", "test", "datehour", "value string", "text").collect()
    assert sorted(map(tuple, got)) == [("late", "20160320", "2016032010"), ("v1", "20160320", "2016032009"), ("v2", "20160320", "2016032010")]
    daily = lake.read_lake(spark, f"{tmp_path}/lake", "daily", "date", "value string", "text").collect()
    assert [tuple(r) for r in daily] == [("d", "20160320")]


def _land(spark, path, batch, *rows):
    made = spark.createDataFrame(list(rows), "message string, topic string, hour string").withColumn("codec", F.lit("gzip"))
    landing.land_by_codec(made, path, run="r", batch=batch)


def test_batches_are_published_once_and_removed(spark, tmp_path):
    path, lake_root = f"{tmp_path}/land", f"{tmp_path}/lake"
    catalog = make_catalog(spark, [
        {"log": "a", "base_partition": f"{lake_root}/", "log_partition": "/all"}, {"log": "b", "base_partition": lake_root, "log_partition": "all/"},
        {"log": "c", "base_partition": lake_root, "log_partition": "all", "date_format": "other"},
    ])
    _land(spark, path, "0", ("one", "a", "2016-03-20-09"), ("two", "b", "2016-03-20-09"), ("day", "c", "2016-03-20-09"))
    assert landed_batches(spark, path) == [("r", "0")]
    for _ in range(2):
        publish_batches(spark, path, [("r", "0")], catalog)
    assert landed_batches(spark, path) == [] and remove_published(spark, path) == 1
    # A late row, and a batch id that the first one's name begins with.
    _land(spark, path, "01", ("late", "a", "2016-03-20-09"))
    publish_batches(spark, path, landed_batches(spark, path), catalog)
    got = spark.read.option("recursiveFileLookup", True).text(f"{lake_root}/all").collect()
    assert sorted(r["value"] for r in got) == ["day", "late", "one", "two"]


def test_a_round_reads_its_own_batch(spark, tmp_path):
    for batch in ("0", "1"):
        _land(spark, f"{tmp_path}/land", batch, (f"m{batch}", "a", "2016-03-20-09"))
    files_read = landing.landed_text(spark, f"{tmp_path}/land", [("r", "1")]).inputFiles()
    assert files_read and all("/batch=1/" in f for f in files_read)


def test_missing_table_is_reported_and_others_go_on(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS audited")
    tables.create_landing_table(spark, "audited.here", "value string", "text")
    url = "jdbc:hive2://lake.example:10000/audited"
    catalog = make_catalog(spark, [
        {"log": t, "base_partition": f"{tmp_path}/lake", "log_partition": t, "hive_table_name": t, "hive_url": url} for t in ("here", "gone")
    ])
    hours = spark.createDataFrame([("here", "2016-03-20-09"), ("gone", "2016-03-20-09")], "topic string, hour string")
    audit = {r["log"]: r["status"] for r in register_partitions(spark, publish_settings(hours, catalog)).collect()}
    assert audit == {"here": "ok", "gone": "error"}
    assert spark.sql("SHOW PARTITIONS audited.here").count() == 1


def test_named_files_are_published_and_corrupt_ones_kept(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "test-2016-03-20-09.gz").write_bytes(gzip.compress(b"one\ntwo\n"))
    (source / "test-2016-03-20-10.1458.gz").write_bytes(gzip.compress(b"three\n"))
    (source / "test-2016-03-20-11.parquet").write_bytes(b"PAR1 broken")
    (source / "noname.parquet").write_bytes(b"PAR1 broken too")
    old = time.time() - 60
    for name in os.listdir(source):
        os.utime(source / name, (old, old))
    defaults = PublishDefaults(base_partition=f"{tmp_path}/lake", quarantine=f"{tmp_path}/q")
    catalog = make_catalog(spark, [])
    checked = files.check_files(files.finished_files(spark, str(source)), str(source))
    quarantine_files(spark, checked, catalog, defaults)
    rows = rows_of_named_files(files.read_finished_text(spark, str(source)))
    publish_rows(rows.withColumn("publication", F.lit("run")), rows.select("topic", "hour"), catalog, defaults)
    got = lake.read_lake(spark, f"{tmp_path}/lake", "test", "datehour", "value string", "text").collect()
    assert sorted(map(tuple, got)) == [("one", "20160320", "2016032009"), ("three", "20160320", "2016032010"), ("two", "20160320", "2016032009")]
    kept = {os.path.relpath(p, tmp_path / "q"): p.read_bytes() for p in (tmp_path / "q").rglob("*.parquet")}
    assert sorted((k.rsplit("/", 2)[0], k.rsplit("/", 1)[1], v) for k, v in kept.items()) == [
        ("test/date=20160320/hour=2016032011", "test-2016-03-20-11.parquet", b"PAR1 broken"), ("unnamed", "noname.parquet", b"PAR1 broken too"),
    ]
    assert sorted(os.listdir(source)) == sorted(n for n in os.listdir(source) if n.endswith((".gz", ".crc")))
    # Moved before: the same call does nothing.
    assert quarantine_files(spark, spark.createDataFrame([], "path string, length bigint, file_ok boolean"), catalog, defaults).count() == 0


def test_hours_are_noted_from_directory_names(spark, tmp_path):
    topics = ["plain", "a b", "x=y", "50%", "p+q", "t:1"]
    rows = spark.createDataFrame([(t, "2016-03-20-09", "m", "gzip") for t in topics], "topic string, hour string, message string, codec string")
    landing.land_by_codec(rows, f"{tmp_path}/out")
    noted = spark.read.schema(landing.HOURS_SCHEMA).parquet(f"{tmp_path}/out/hours/text").select("topic", "hour")
    assert sorted(map(tuple, noted.collect())) == sorted((t, "2016-03-20-09") for t in topics)
    landed = landing.landed_text(spark, f"{tmp_path}/out")
    assert sorted(r["topic"] for r in landed.collect()) == sorted(topics)
    defaults = PublishDefaults(base_partition=f"{tmp_path}/lake")
    publish_batches(spark, f"{tmp_path}/out", landed_batches(spark, f"{tmp_path}/out"), make_catalog(spark, []), defaults)
    assert spark.read.option("recursiveFileLookup", True).text(f"{tmp_path}/lake").count() == len(topics)


def test_rows_without_a_sink_come_back(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", "2016-03-20-09", "m", "zip"), ("a", "2016-03-20-09", "m", None), ("", "2016-03-20-09", "m", "gzip"), ("a", "2016-03-20-09", "m", "gzip")],
        "topic string, hour string, message string, codec string",
    )
    back = landing.land_by_codec(rows, f"{tmp_path}/out")
    assert sorted(r["error"] for r in back.collect()) == ["message has no topic", "no sink for codec NULL", "no sink for codec zip"]
    assert landing.landed_text(spark, f"{tmp_path}/out").count() == 1
    with pytest.raises(RuntimeError, match="spark-avro"):
        landing.land_by_codec(rows.withColumn("codec", F.lit("avro")), f"{tmp_path}/out")


def test_lower_cased_schemas():
    schema = StructType.fromDDL("`MyCol ` INT, ABC INT, message STRUCT<VGUID: STRING, l: ARRAY<STRUCT<X: INT>>>, m MAP<STRING, STRUCT<K: INT>>, dt STRING, HR STRING")
    got = tables.write_schema(schema)
    assert got.simpleString() == "struct<mycol:int,abc:int,message:struct<vguid:string,l:array<struct<x:int>>>,m:map<string,struct<k:int>>>"


def test_conform_casts_and_never_fails(spark):
    rows = spark.createDataFrame([("12", "x"), ("nine", "y")], "A string, b string")
    got = tables.conform(rows, StructType.fromDDL("a int, c string"))
    assert [tuple(r) for r in got.collect()] == [(12, None), (None, None)]


def test_schemas_by_topic(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS schemas")
    tables.create_landing_table(spark, "schemas.wide", "A bigint, b string")
    catalog = make_catalog(spark, [
        {"log": "p", "output_format": "parquet", "hive_table_name": "schemas.wide"},
        {"log": "j", "output_format": "json", "hive_table_name": "schemas.wide"},
        {"log": "gone", "output_format": "parquet", "hive_table_name": "schemas.gone"},
        {"log": "known", "output_format": "parquet", "hive_table_name": "schemas.wide"},
    ])
    known = StructType.fromDDL("z int")
    got = tables.schemas_by_topic(catalog, {"known": known})
    assert {t: s.simpleString() for t, s in got.items()} == {"known": "struct<z:int>", "p": "struct<a:bigint,b:string>"}


def test_partition_statement_is_retried(spark):
    calls = []

    class Broken:
        def sql(self, statement):
            calls.append(statement)
            if len(calls) < 3:
                raise RuntimeError("try again")

    places = [("20160320", "2016032009", "/x"), ("20160320", "2016032010", "/y")]
    assert tables.add_partitions(Broken(), "t", places, pause=0) is None
    assert len(calls) == 3 and calls[0].endswith(
        "IF NOT EXISTS PARTITION (dt='20160320', hr='2016032009') LOCATION '/x' PARTITION (dt='20160320', hr='2016032010') LOCATION '/y'"
    )
    calls.clear()
    assert tables.add_partitions(Broken(), "t", places, retries=1, pause=0) == "try again" and len(calls) == 2
    assert "TABLE_OR_VIEW_NOT_FOUND" in tables.add_partitions(spark, "nowhere.t", places, pause=60)


def test_generated_messages(spark):
    rows = generator.generate_messages(spark, 4, 25)
    assert rows.rdd.getNumPartitions() == 4 and rows.count() == 100
    assert rows.filter(F.col("data").rlike("^[A-Z]{100}$")).count() == 100
    assert rows.select("data").distinct().count() == 100


def test_message_bytes(spark):
    assert bytes(spark.range(1).select(landing.message_bytes(F.lit("é"))).first()[0]) == "é\n".encode()


def test_search_documents_take_text_only(spark):
    rows = spark.createDataFrame(
        [("a", ["x", "y"], "txt", None), ("b", ["r"], "avro-txt", None), ("c", None, "txt", "bad")],
        "topic string, fields array<string>, format_type string, error string",
    )
    assert [tuple(r) for r in reports.search_documents(rows).collect()] == [("a", "x")]
