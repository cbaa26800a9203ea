import functools

from pyspark.sql import functions as F

from rillflow.functions.keys import jdbc_database
from rillflow.operators import catalog as ops
from rillflow.operators import parse
from rillflow.operators.lookup import _pieces, first_per_key, lookup_join, measured_bytes

ORDERS = {
    "log": "orders", "base_partition": "/warehouse/raw", "log_partition": "orders_v2", "hive_url": "jdbc:hive2://lake.example:10000/sales",
    "quarantine": "/warehouse/rejects", "date_format": "date", "hive_user": "loader", "hive_password": "s3",
}


def test_known_and_unknown_topics(spark):
    catalog = ops.make_catalog(spark, [ORDERS])
    topics = spark.createDataFrame([("orders",), ("web-hits",)], "topic string")
    rows = {r["topic"]: r.asDict() for r in ops.with_publish_settings(topics, catalog).collect()}
    stored = {c: v for c, v in ORDERS.items() if c != "log"}
    assert rows["orders"] == {"topic": "orders", "hive_db_name": "sales", "hive_table_name": "orders", **stored}
    assert rows["web-hits"] == {
        "topic": "web-hits", "base_partition": "/log/rillflow", "log_partition": "web-hits", "hive_db_name": "rillflow",
        "hive_table_name": "web_hits", "date_format": "datehour", "quarantine": "/tmp/rillflow-quarantine",
        "hive_url": None, "hive_user": "hive", "hive_password": "",
    }


def test_jdbc_databases(spark):
    urls = {
        "jdbc:mariadb:sequential://one.example:3307,two.example:3308/stock": "stock",
        "jdbc:hive2://lake.example:10000/sales?connectTimeout=5": "sales",
        "jdbc:postgresql://pg.example/ledger?user=reader&sslmode=require": "ledger",
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(jdbc_database(F.col("u"))).collect()] == list(urls.values())


def test_start_and_stop_sets(spark):
    catalog = ops.make_catalog(spark, [
        {"log": "a", "log_group": "etl"}, {"log": "b", "log_group": "etl"},
        {"log": "off", "log_group": "etl", "enabled": 0}, {"log": "other"},
    ])
    enabled = ops.enabled_topics(catalog, "etl")
    active = spark.createDataFrame([("b",), ("c",)], "log string")
    assert [r["log"] for r in ops.topics_to_start(enabled, active).collect()] == ["a"]
    assert [r["log"] for r in ops.topics_to_stop(enabled, active).collect()] == ["c"]


def test_disable_topic(spark):
    catalog = ops.make_catalog(spark, [{"log": "test", "log_group": "etl"}, {"log": "kept", "log_group": "etl"}])
    off = ops.disable_topics(catalog, spark.createDataFrame([("test",)], "topic string"))
    assert {r["log"]: r["enabled"] for r in off.collect()} == {"test": 0, "kept": 1}
    assert off.columns == catalog.columns
    assert ops.topic_row(off, "test").first()["enabled"] == 0


def test_salted_lookup_equals_broadcast(spark):
    # One key holds a third of all rows.
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 50, 2)], "key string, v int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        small = lookup_join(left, right, "k", "key", how)
        large = lookup_join(left, right, "k", "key", how, broadcast_bytes=0)
        assert small.columns == large.columns
        assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)
    large = lookup_join(left, right, "k", "key", "left", broadcast_bytes=0)
    assert large.count() == 3000
    assert large.filter(F.col("k") == "hot").filter(F.col("v") == 1).count() == 1000


def test_size_is_measured(spark):
    assert measured_bytes(spark.createDataFrame([("abc",)], "a string")) == len('{"a":"abc"}')
    assert measured_bytes(spark.createDataFrame([], "a string")) == 0


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, v int")
    assert sorted(map(tuple, first_per_key(df, "k", ["v"]).collect())) == [("a", 1), ("b", 3)]


def test_equal_rows_and_maps_take_many_salts(spark):
    # 32 000 equal rows of one topic, with a column that cannot be hashed.
    left = spark.range(0, 32_000, 1, 4).select(F.lit("beat").alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    right = spark.createDataFrame([("beat", 1), ("other", 2)], "key string, v int")
    small = lookup_join(left, right, "k", "key", "left")
    large = lookup_join(left, right, "k", "key", "left", broadcast_bytes=0, salts=32)
    assert small.count() == large.filter("v = 1").count() == 32_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(left, right, "k", "key", "left", broadcast_bytes=0, salts=32)
        assert joined.select(F.spark_partition_id()).distinct().count() >= 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_side_is_not_broadcast_by_its_estimate(spark):
    left = spark.range(2000).select("id", (F.col("id") % 500).cast("string").alias("k"))
    right = spark.range(500).select(F.col("id").cast("string").alias("key"), F.col("id").alias("v"))
    joined = lookup_join(left, right, "k", "key", broadcast_bytes=0)
    assert "SortMergeJoin" in _plan(joined) and "Broadcast" not in _plan(joined)
    assert joined.filter(F.col("v") == F.col("id") % 500).count() == 2000


def test_salted_lookup_of_null_repeated_and_other_typed_keys(spark):
    # Half of the keys are NULL, a quarter one key that comes twice in the side.
    left = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 4 == 1, F.col("id") % 100).cast("int").alias("k"))
    for kind in ("int", "bigint"):
        right = spark.createDataFrame([(7, "a"), (7, "b"), (None, "c"), (13, "d")], f"key {kind}, v string")
        for how in ("left", "inner", "left_semi", "left_anti"):
            small = lookup_join(left, right, "k", "key", how)
            large = lookup_join(left, right, "k", "key", how, broadcast_bytes=0)
            assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)


def test_side_is_not_repeated_without_heavy_keys(spark):
    topics = spark.range(300).select(F.concat(F.lit("t"), "id").alias("topic"))
    side = topics.select(F.col("topic").alias("log"), F.lit("v").alias("v"))
    joined = lookup_join(topics, side, "topic", "log", broadcast_bytes=0)
    assert "Generate" not in _plan(joined) and joined.filter("v = 'v'").count() == 300


def test_side_grows_by_heavy_keys_alone(spark):
    # A third of the rows hold one key: it gets a third of the salts and no other key is repeated.
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    pieces = _pieces(left, F.pmod(F.xxhash64("k"), F.lit(2048)), 32)
    assert [r["_pieces"] for r in pieces.collect()] == [11]
    assert _pieces(left.distinct(), F.pmod(F.xxhash64("k"), F.lit(2048)), 32) is None
    assert _pieces(left.limit(0), F.pmod(F.xxhash64("k"), F.lit(2048)), 32) is None


def test_settings_of_a_catalog_past_the_bound(spark, monkeypatch):
    # Every topic has few rows: the catalog is joined as it is, not once for each salt.
    catalog = ops.make_catalog(spark, [{"log": f"t{i}", "base_partition": f"/lake/{i}"} for i in range(300)])
    topics = spark.range(600).select(F.concat(F.lit("t"), F.col("id") % 400).alias("topic"))
    small = ops.with_publish_settings(topics, catalog)
    monkeypatch.setattr(ops, "lookup_join", functools.partial(lookup_join, broadcast_bytes=0))
    large = ops.with_publish_settings(topics, catalog)
    assert "Generate" not in _plan(large) and "Broadcast" not in _plan(large)
    assert small.columns == large.columns
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)


def test_messages_of_a_catalog_past_the_bound(spark, monkeypatch):
    catalog = ops.make_catalog(spark, [{"log": f"t{i}", "format": "txt:sep=pipe;ts_sec=0;msg=1", "output_format": "parquet"} for i in range(300)])
    line = F.encode(F.concat(F.lit("9|m"), "id"), "UTF-8").alias("value")
    even = spark.range(600).select((F.col("id") % 400).alias("n"), line)
    # A third of all messages are of one topic.
    heavy = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400).alias("n"), line)
    for numbered, repeats in ((even, False), (heavy, True)):
        messages = numbered.select(F.concat(F.lit("t"), "n").alias("topic"), "value")
        small = parse.parse_messages(messages, catalog)
        with monkeypatch.context() as past:
            past.setattr(parse, "lookup_join", functools.partial(lookup_join, broadcast_bytes=0))
            large = parse.parse_messages(messages, catalog)
        # The described topics are repeated by the pieces of heavy keys or not at all.
        assert ("explode(" in _plan(large)) == repeats and "SortMergeJoin" in _plan(large)
        assert small.columns == large.columns
        assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)
