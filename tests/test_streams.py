import threading

import pytest
from pyspark.sql import functions as F

from rillflow.functions import avro
from rillflow.operators.catalog import load_catalog, make_catalog, save_catalog
from rillflow.operators.parse import parse_messages
from rillflow.plans.ingest import IngestPlan
from rillflow.sinks import landing, reports
from rillflow.sources import kafka
from rillflow.sources.files import stream_messages
from rillflow.sources.generator import RECORD_SCHEMA
from rillflow.streaming import ingest
from rillflow.streaming.topics import follow_catalog, reconcile


def raw(spark, rows):
    return spark.createDataFrame([(t, bytearray(v.encode())) for t, v in rows], "topic string, value binary")


def test_stream_restarts_from_its_checkpoint_and_picks_up_the_catalog(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "catalog")
    save_catalog(make_catalog(spark, [{"log": "a", "format": "txt:sep=pipe;ts=0;msg=1"}]), state, 1)
    plan = ingest.StreamPlan(
        IngestPlan(f"{tmp_path}/land", writers=2), lambda: load_catalog(spark, state), f"{tmp_path}/cp",
        quarantine=f"{tmp_path}/bad", counters=f"{tmp_path}/n", errors=f"{tmp_path}/e", error_threshold=3,
        on_flagged=ingest.disable_flagged(lambda: load_catalog(spark, state), lambda c: save_catalog(c.repartition(1), state, 2)),
    )

    def run():
        stream = stream_messages(spark, source, "topic string, value binary")
        ingest.start_ingest(stream, plan, available_now=True).awaitTermination()

    raw(spark, [("a", "1458465011123|one"), ("a", "x|bad")]).coalesce(1).write.mode("append").parquet(source)
    run()
    raw(spark, [("a", "1458465011123|two"), ("b", "1|2")] + [("a", "y|bad")] * 3).coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    landed = landing.landed_text(spark, f"{tmp_path}/land").select("value", "topic", "hour").collect()
    assert sorted(map(tuple, landed)) == [("one", "a", "2016-03-20-09"), ("two", "a", "2016-03-20-09")]
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 5
    live = reports.live_counters(spark, f"{tmp_path}/n")
    assert live.filter("phase = 'in'").agg(F.sum("n")).first()[0] == 2
    # One error and then three more passed the threshold of three; b has only one.
    run = ingest.query_id(spark, plan.checkpoint)
    totals = {r["topic"]: tuple(r)[1:] for r in spark.read.parquet(f"{tmp_path}/e/run={run}/batch=1").collect()}
    assert totals == {"a": (4, 1, True), "b": (1, 0, False)}
    assert load_catalog(spark, state).first()["enabled"] == 0


def test_batch_run_again_leaves_the_same_files(spark, tmp_path):
    catalog = make_catalog(spark, [{"log": "a", "format": "txt:sep=pipe;ts=0;msg=1", "output_format": "snappy"}])
    plan = ingest.StreamPlan(IngestPlan(f"{tmp_path}/land"), lambda: catalog, "unused", quarantine=f"{tmp_path}/bad", counters=f"{tmp_path}/n")
    batch = raw(spark, [("a", "1458465011123|one"), ("a", "nope")])
    flagged = []
    plan.errors, plan.error_threshold, plan.on_flagged = f"{tmp_path}/e", 0, lambda df: flagged.append([r["topic"] for r in df.collect()])
    for _ in range(2):
        ingest.IngestStream(plan, "q")(batch, 7)
    assert flagged == [["a"], ["a"]] and spark.read.parquet(f"{tmp_path}/e/run=q/batch=7").first()["errors"] == 1
    assert landing.landed_text(spark, f"{tmp_path}/land").count() == 1
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 1
    assert {r["phase"]: r["n"] for r in reports.live_counters(spark, f"{tmp_path}/n").collect()} == {"in": 1, "error": 1}
    # Another query with the same batch id has folders of its own.
    ingest.IngestStream(plan, "r")(batch, 7)
    assert landing.landed_text(spark, f"{tmp_path}/land").count() == 2
    assert reports.expire_counters(spark, f"{tmp_path}/n") == 0
    assert reports.expire_counters(spark, f"{tmp_path}/n", expiry_seconds=-1) == 2


def test_topics_follow_the_catalog(spark):
    class Query:
        isActive = True

        def stop(self):
            self.isActive = False

    b, c = Query(), Query()
    running = {"b": b, "c": c}
    catalog = make_catalog(spark, [{"log": "a", "log_group": "g"}, {"log": "b", "log_group": "g"}, {"log": "c", "log_group": "g", "enabled": 0}])
    assert reconcile(catalog, "g", running, lambda topic: Query()) == (["a"], ["c"])
    assert set(running) == {"a", "b"} and not c.isActive and b.isActive
    assert reconcile(catalog, "g", running, lambda topic: Query()) == ([], [])
    # A query that failed is started again.
    running["b"].stop()
    assert reconcile(catalog, "g", running, lambda topic: Query()) == (["b"], [])
    stopped = threading.Event()
    stopped.set()
    ended = follow_catalog(lambda: catalog, "g", lambda topic: Query(), stopped, 1)
    assert set(ended) == {"a", "b"} and not any(q.isActive for q in ended.values())


def test_kafka_options(spark):
    assert kafka.stream_options("b:9092", ["y", "x"], earliest=True) == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "x,y", "startingOffsets": "earliest",
    }
    limited = kafka.stream_options("b:9092", ["x"], max_per_trigger=50)
    assert limited["startingOffsets"] == "latest" and limited["maxOffsetsPerTrigger"] == "50"
    assert kafka.replay_options("b:9092", "x")["endingOffsets"] == "latest"
    if not kafka.has_kafka_package(spark):
        with pytest.raises(RuntimeError):
            kafka.stream_topics(spark, "b:9092", ["x"])


def test_avro_needs_its_package(spark):
    if avro.has_avro_package(spark):
        pytest.skip("the package is here")
    catalog = make_catalog(spark, [{"log": "t", "format": "avro-txt:ts=0;msg=1"}])
    with pytest.raises(RuntimeError, match="spark-avro"):
        parse_messages(raw(spark, [("t", "junk")]), catalog, {"t": RECORD_SCHEMA})


def test_frames(spark):
    rows = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07ab"),), (bytearray(b"\x01\x00\x00\x00\x07ab"),), (bytearray(b"\x00"),), (None,)], "v binary")
    got = [r[0] for r in rows.select(avro.strip_header(F.col("v"))).collect()]
    assert [None if g is None else bytes(g) for g in got] == [b"ab", None, None, None]
    assert bytes(spark.range(1).select(avro.add_header(F.lit(b"ab"), 7)).first()[0]) == b"\x00\x00\x00\x00\x07ab"


def test_record_fields_by_position(spark):
    df = spark.createDataFrame([((5, "x", 1.5),), ((None, None, None),), (None,)], "r struct<a: bigint, b: string, c: double>")
    schema, record = df.schema["r"].dataType, F.col("r")
    got = df.select(
        avro.record_millis(record, schema, 0).alias("ms"), avro.record_text(record, schema, 1).alias("b"), avro.record_text(record, schema, 7).alias("none"),
        avro.record_text(record, schema, -1).alias("all"),
    ).collect()
    assert tuple(got[0]) == (5, "x", None, '{"a":5,"b":"x","c":1.5}') and got[1]["b"] is None and got[1]["ms"] > 10**12
