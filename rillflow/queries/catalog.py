"""Topic-catalog queries: selection, defaults, codecs, lookups, start and stop sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillflow.operators import catalog as ops
from rillflow.operators.lookup import first_per_key, lookup_join
from rillflow.operators.parse import parse_messages
from rillflow.queries import Registry
from rillflow.queries.feeds import (
    CUSTOMER_CATALOG_SQL,
    ORDER_LINE_SQL,
    ORDER_TOPIC_SQL,
    customer_catalog,
    order_messages,
    table,
)

QUERIES = Registry()

_CATALOG = f"WITH catalog AS ({CUSTOMER_CATALOG_SQL})"
_CODEC = """CASE lower(output_format) WHEN 'parquet' THEN 'parquet' WHEN 'txt' THEN 'none' WHEN 'snappy' THEN 'snappy'
            WHEN 'bzip2' THEN 'bzip2' ELSE CASE WHEN output_format IS NULL THEN 'none' ELSE 'gzip' END END"""


@QUERIES.add(f"{_CATALOG} SELECT log FROM catalog WHERE log_group = 'BUILDING' AND enabled = 1")
def enabled_topics(spark, sf_dir):
    return ops.enabled_topics(customer_catalog(spark, sf_dir), "BUILDING")


@QUERIES.add(f"{_CATALOG} SELECT log, coalesce(lower(output_format), 'txt') AS output, {_CODEC} AS codec FROM catalog")
def codec_choice(spark, sf_dir):
    output = ops.output_format_or_default(F.col("output_format"))
    return customer_catalog(spark, sf_dir).select("log", output.alias("output"), ops.codec_for(output).alias("codec"))


@QUERIES.add(f"""
    {_CATALOG}, m AS (SELECT o_orderkey, {ORDER_TOPIC_SQL} AS topic, {ORDER_LINE_SQL} AS line, epoch_us(o_orderdate) // 1000 AS ms FROM orders),
    j AS (SELECT m.*, c.log, coalesce(c.format, 'txt') AS format, {_CODEC} AS codec FROM m LEFT JOIN catalog c ON m.topic = c.log)
    SELECT o_orderkey, topic, CASE WHEN log IS NOT NULL THEN string_split(format, ':')[1] END AS format_type, codec,
           CASE format WHEN 'txt:sep=pipe;ts_sec=2;msg=0:2' THEN array_to_string(string_split(line, '|')[1:2], '|')
                       WHEN 'txt:sep=pipe;ts_sec=2;msg=1' THEN string_split(line, '|')[2] END AS message,
           CASE WHEN format LIKE 'txt:%' THEN ms END AS ts_ms,
           CASE WHEN format LIKE 'avro%' THEN 'no Avro schema given for the topic'
                WHEN format = 'txt' THEN 'format names no ts, ts_ms or ts_sec field' END AS error
    FROM j""")
def catalog_join(spark, sf_dir):
    """Every order line parsed with the descriptor of its customer's topic."""
    parsed = parse_messages(order_messages(spark, sf_dir), customer_catalog(spark, sf_dir))
    return parsed.select("o_orderkey", "topic", "format_type", "codec", "message", "ts_ms", "error")


@QUERIES.add(f"""
    {_CATALOG}, m AS (SELECT o_orderkey, {ORDER_TOPIC_SQL} AS topic FROM orders)
    SELECT o_orderkey, topic, log_group, enabled FROM m LEFT JOIN catalog c ON m.topic = c.log""")
def catalog_join_salted(spark, sf_dir):
    """The same lookup with a catalog past the broadcast bound: both sides salted."""
    side = customer_catalog(spark, sf_dir).select("log", "log_group", "enabled")
    joined = lookup_join(order_messages(spark, sf_dir).drop("value"), side, "topic", "log", broadcast_bytes=0)
    return joined.select("o_orderkey", "topic", "log_group", "enabled")


@QUERIES.add(f"""
    {_CATALOG}, t AS (SELECT c_name AS topic FROM customer UNION ALL SELECT s_name FROM supplier)
    SELECT topic, c.log IS NOT NULL AS known,
           CASE WHEN c.log IS NULL THEN '/log/rillflow' ELSE base_partition END AS base_partition,
           CASE WHEN c.log IS NULL THEN topic ELSE log_partition END AS log_partition,
           CASE WHEN hive_url IS NULL THEN 'rillflow' ELSE string_split(string_split(hive_url, '/')[-1], '?')[1] END AS hive_db_name,
           CASE WHEN c.log IS NULL THEN replace(topic, '-', '_') ELSE coalesce(hive_table_name, topic) END AS hive_table_name,
           CASE WHEN c.log IS NULL THEN 'datehour' ELSE date_format END AS date_format,
           CASE WHEN c.log IS NULL THEN '/tmp/rillflow-quarantine' ELSE quarantine END AS quarantine,
           hive_url,
           CASE WHEN c.log IS NULL THEN 'hive' ELSE hive_user END AS hive_user,
           CASE WHEN c.log IS NULL THEN '' ELSE hive_password END AS hive_password
    FROM t LEFT JOIN catalog c ON t.topic = c.log""")
def catalog_defaults(spark, sf_dir):
    """Customers have a catalog row, suppliers take every default."""
    topics = table(spark, sf_dir, "customer").select(F.col("c_name").alias("topic")).unionAll(
        table(spark, sf_dir, "supplier").select("s_name")
    )
    known = topics.withColumn("known", F.col("topic").startswith("Customer"))
    return ops.with_publish_settings(known, customer_catalog(spark, sf_dir))


_ACTIVE = f"active AS (SELECT DISTINCT {ORDER_TOPIC_SQL} AS log FROM orders WHERE o_orderstatus = 'F')"
_ENABLED = "enabled AS (SELECT log FROM catalog WHERE log_group = 'BUILDING' AND enabled = 1)"


def _active(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return orders.select(F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("log")).distinct()


@QUERIES.add(f"{_CATALOG}, {_ENABLED}, {_ACTIVE} SELECT log FROM enabled EXCEPT SELECT log FROM active")
def topics_to_start(spark, sf_dir):
    enabled = ops.enabled_topics(customer_catalog(spark, sf_dir), "BUILDING")
    return ops.topics_to_start(enabled, _active(spark, sf_dir))


@QUERIES.add(f"{_CATALOG}, {_ENABLED}, {_ACTIVE} SELECT log FROM active EXCEPT SELECT log FROM enabled")
def topics_to_stop(spark, sf_dir):
    enabled = ops.enabled_topics(customer_catalog(spark, sf_dir), "BUILDING")
    return ops.topics_to_stop(enabled, _active(spark, sf_dir))


@QUERIES.add("""
    SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus
    FROM orders GROUP BY o_custkey""")
def first_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return first_per_key(orders, "o_custkey", ["o_orderkey"])


@QUERIES.add(f"{_CATALOG} SELECT log, format, date_format, enabled FROM catalog")
def stored_catalog(spark, sf_dir):
    """A catalog stored twice and read back; the newest snapshot is the one read."""
    from rillflow.session import work_dir

    path = work_dir(spark, "catalog")
    catalog = customer_catalog(spark, sf_dir)
    ops.save_catalog(catalog.withColumn("enabled", F.lit(0)), path, 1)
    ops.save_catalog(catalog, path, 2)
    return ops.load_catalog(spark, path).select("log", "format", "date_format", "enabled")
