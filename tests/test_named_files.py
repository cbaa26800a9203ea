import gzip
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow.operators import tables
from rillflow.operators.catalog import PublishDefaults, make_catalog
from rillflow.plans import named_files, versions
from rillflow.sinks import landing, reports


@pytest.fixture
def feed(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "[a] {b}-2016-03-20-09.gz").write_bytes(gzip.compress(b"one\ntwo\n"))
    (source / "c-2016-03-20-10.gz").write_bytes(gzip.compress(b"three\n"))
    (source / "c-2016-03-20-11.parquet").write_bytes(b"PAR1 broken")
    (source / "noname.gz").write_bytes(gzip.compress(b"lost\n"))
    for topic in ("typed", "later"):
        rows = spark.createDataFrame([("7", ("x", 1.5))], "ID string, Pair struct<Name: string, Size: double>")
        rows.coalesce(1).write.parquet(f"{tmp_path}/{topic}")
        part = next(n for n in os.listdir(tmp_path / topic) if n.endswith(".parquet"))
        os.rename(tmp_path / topic / part, source / f"{topic}-2016-03-20-12.parquet")
    old = time.time() - 60
    for name in os.listdir(source):
        os.utime(source / name, (old, old))
    (source / "young-2016-03-20-09.gz").write_bytes(gzip.compress(b"y\n"))
    return source


@pytest.fixture
def schemas(spark):
    return {"typed": StructType.fromDDL("id bigint, pair struct<size: double, name: string>")}


def place(tmp_path):
    return PublishDefaults(base_partition=f"{tmp_path}/lake", quarantine=f"{tmp_path}/q"), f"{tmp_path}/log"


def data_files(folder):
    return sorted(n for n in os.listdir(folder) if not n.startswith("."))


def test_a_round_publishes_moves_and_waits(spark, tmp_path, feed, schemas):
    defaults, log = place(tmp_path)
    catalog = make_catalog(spark, [])
    assert named_files.publish_named_files(spark, str(feed), log, catalog, defaults, "h", schemas) == [0]
    assert named_files.publish_named_files(spark, str(feed), log, catalog, defaults, "h", schemas) == []
    assert data_files(feed) == ["later-2016-03-20-12.parquet", "young-2016-03-20-09.gz"]
    live = versions.live_files(spark, log)
    text = versions.read_published(spark, log).filter(F.col("place").rlike("date=20160320/hour=20160320(09|10)$"))
    assert live.count() == 3 and sorted(r["value"] for r in text.collect()) == ["one", "three", "two"]
    typed = [r["path"] for r in live.collect() if "/hour=2016032012" in r["place"]]
    row = spark.read.parquet(*typed).first()
    assert (row["id"], row["pair"]["size"], row["pair"]["name"]) == (7, 1.5, "x")
    audit = {(r["log_name"], r["status"], r["host"], r["file_size"] > 0) for r in named_files.read_audit(spark, log).collect()}
    assert audit == {("[a] {b}", "complete", "h", True), ("c", "complete", "h", True), ("typed", "complete", "h", True), ("c", "corrupt", "h", True), (None, "unnamed", "h", True)}
    kept = sorted(p.name for p in (tmp_path / "q").rglob("*.*") if p.is_file() and not p.name.startswith("."))
    assert kept == ["c-2016-03-20-11.parquet", "noname.gz"]


@pytest.mark.parametrize("broken", ["quarantine_files", "file_audit", "remove"])
def test_a_stopped_round_is_finished(spark, tmp_path, feed, schemas, monkeypatch, broken):
    defaults, log = place(tmp_path)
    catalog = make_catalog(spark, [])
    assert named_files.begin_round(spark, str(feed), log, schemas) == 0

    def stops(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(named_files, broken, stops)
        with pytest.raises(RuntimeError):
            named_files.finish_round(spark, log, 0, catalog, defaults)
    # The topic's schema is gone meanwhile: the ledger has kept it.
    assert named_files.publish_named_files(spark, str(feed), log, catalog, defaults) == [0]
    assert versions.live_files(spark, log).count() == 3
    assert named_files.upload_meters(spark, log).agg(F.sum("files")).first()[0] == 5
    assert data_files(feed) == ["later-2016-03-20-12.parquet", "young-2016-03-20-09.gz"]


def test_nested_values_are_matched_by_name(spark):
    rows = spark.range(1).select(F.expr("""named_struct('B', '5', 'a', array(named_struct('Y', 1, 'x', 2))) AS S"""), F.lit('{"k": 3}').alias("j"), F.lit(4).alias("n"), F.expr("map('k', named_struct('V', '9')) AS m"))
    schema = StructType.fromDDL("s struct<a: array<struct<x: bigint, z: string, y: int>>, b: int>, j struct<k: int>, n array<int>, m map<string, struct<v: int>>")
    got = tables.conform(rows, schema).first()
    assert got["s"].asDict(True) == {"a": [{"x": 2, "z": None, "y": 1}], "b": 5}
    assert got["j"]["k"] == 3 and got["n"] is None and got["m"]["k"]["v"] == 9
    assert tables.conform(spark.createDataFrame([(None,)], "s struct<a: int>"), StructType.fromDDL("s struct<a: int>")).first()["s"] is None


def test_topics_of_one_schema_share_a_write(spark, tmp_path):
    schemas = {"a": StructType.fromDDL("x int, y string"), "b": StructType.fromDDL("y string, x int"), "c": StructType.fromDDL("x string")}
    groups = tables.schema_groups(schemas)
    assert sorted(topics for _, topics in groups.values()) == [["a", "b"], ["c"]]
    rows = spark.createDataFrame([(t, "2016-03-20-09", "parquet", "1", "q") for t in "abc"], "topic string, hour string, codec string, x string, y string")
    for _ in range(2):
        landing.land_by_codec(rows, f"{tmp_path}/out", mode="overwrite", schemas=schemas)
    # A schema that has changed before the batch runs again leaves nothing behind.
    changed = {**schemas, "c": StructType.fromDDL("y string")}
    landing.land_by_codec(rows, f"{tmp_path}/out", mode="overwrite", schemas=changed)
    found = landing.landed_tables(spark, f"{tmp_path}/out", changed)
    assert sorted(r["topic"] for df in found.values() for r in df.collect()) == ["a", "b", "c"]
    assert sum(df.count() for df in landing.landed_tables(spark, f"{tmp_path}/out", schemas).values()) == 2
    hours = spark.read.schema(landing.HOURS_SCHEMA).parquet(f"{tmp_path}/out/hours/tables")
    assert hours.count() == 3


def test_folded_batches_count_once(spark, tmp_path):
    path = str(tmp_path)

    def publish(run, batch, n=1):
        rows = spark.createDataFrame([("in", "a", "201603200910", n)], "phase string, topic string, minute string, n bigint")
        reports.publish_counters(rows, path, run, batch)

    def total():
        return [r["n"] for r in reports.live_counters(spark, path).collect()]

    for batch in ("0", "1", "3", "4"):
        publish("q", batch)
    publish("p", "first-of-all")
    publish("p", "007")
    assert reports.fold_counters(spark, path) == 3 and total() == [6]
    publish("q", "0")
    assert total() == [6]
    # It fills a gap: no batch of that number is in the snapshot.
    publish("q", "2")
    assert total() == [7]
    publish("q", "4", 5)
    assert total() == [11]
    assert reports.fold_counters(spark, path) == 1 and total() == [11]
    assert reports.fold_counters(spark, path) == 0 and total() == [11]
    assert sorted(n for n in os.listdir(tmp_path / "run=q") if n.startswith("batch")) == ["batch=4"]
    later = F.current_timestamp() + F.expr("INTERVAL 25 HOURS")
    assert reports.live_counters(spark, path, later).count() == 0
