"""Message feeds and catalogs that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators.catalog import make_catalog

EVENT_LINE_SQL = "concat_ws('|', event_id, user_id, event_type, epoch_us(ts) // 1000)"
ORDER_LINE_SQL = "concat_ws('|', o_orderkey, o_orderstatus, epoch_us(o_orderdate) // 1000000, o_orderpriority)"
ORDER_TOPIC_SQL = "concat('Customer#', lpad(CAST(o_custkey AS VARCHAR), 9, '0'))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bytes_of(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def pick(number: Column, *choices: str | None) -> Column:
    """The choice at ``number`` modulo the number of choices."""
    chosen = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, choice in enumerate(choices):
        chosen = chosen.when(number % len(choices) == i, F.lit(choice).cast("string"))
    return chosen


def pick_sql(number: str, *choices: str | None) -> str:
    cases = " ".join(
        f"WHEN {number} % {len(choices)} = {i} THEN " + ("NULL" if c is None else f"'{c}'") for i, c in enumerate(choices)
    )
    return f"CASE {cases} END"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as a timestamp and ``ms`` as epoch milliseconds."""
    df = table(spark, sf_dir, "events")
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("ms", F.unix_millis("ts"))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, topic, value``: one piped line per event, its type as the topic."""
    line = F.concat_ws("|", "event_id", "user_id", "event_type", "ms")
    return events(spark, sf_dir).select("event_id", F.col("event_type").alias("topic"), bytes_of(line).alias("value"))


def event_lines(df: DataFrame) -> DataFrame:
    """``event_id, topic, value`` of an events table, also as a stream."""
    line = F.concat_ws("|", "event_id", "user_id", "event_type", F.unix_millis(F.col("ts").cast("timestamp")))
    return df.select("event_id", F.col("event_type").alias("topic"), bytes_of(line).alias("value"))


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rillflow.operators.parse import parse_with_descriptor

    return parse_with_descriptor(event_messages(spark, sf_dir), "txt:sep=pipe;msg=0:3;ts=3")


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, topic, value``: one piped line per order, its customer as the topic."""
    df = table(spark, sf_dir, "orders")
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    line = F.concat_ws("|", "o_orderkey", "o_orderstatus", seconds, "o_orderpriority")
    topic = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    return df.select("o_orderkey", topic.alias("topic"), bytes_of(line).alias("value"))


# One descriptor per event type, with every way to fail among them.
EVENT_CATALOG = [
    {"log": "click", "format": "txt:sep=pipe;ts=3;msg=0:3", "output_format": "parquet", "log_group": "etl", "base_partition": "/lake", "log_partition": "click", "hive_url": "jdbc:hive2://lake.example:10000/clicks"},
    {"log": "error", "format": "txt:sep=comma;ts=0", "output_format": "txt", "log_group": "etl"},
    {"log": "purchase", "format": "txt:sep=pipe;ts=3;msg=1", "output_format": "Snappy", "log_group": "etl", "date_format": "date"},
    {"log": "view", "format": "json:ts=0", "log_group": "web", "enabled": 0},
]


def event_catalog(spark: SparkSession) -> DataFrame:
    """Four of the five event types; ``signup`` has no row."""
    return make_catalog(spark, EVENT_CATALOG)


def landing_catalog(spark: SparkSession) -> DataFrame:
    """All five event types with usable text descriptors and different codecs."""
    formats = {"click": "json", "error": "txt", "purchase": "snappy", "signup": "bzip2", "view": "parquet"}
    return make_catalog(spark, [
        {"log": log, "format": "txt:sep=pipe;msg=0:3;ts=3", "output_format": fmt, "base_partition": "/lake", "log_partition": log}
        for log, fmt in formats.items()
    ])


FORMATS = ("txt:sep=pipe;ts_sec=2;msg=0:2", None, "txt:sep=pipe;ts_sec=2;msg=1", "avro-txt:ts=0;msg=1")
OUTPUTS = ("Parquet", "txt", "SNAPPY", "bzip2", "json", None, "avro")
LAYOUTS = ("datehour", "date", None)


def customer_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog with a topic per customer; it grows with the customer table."""
    key = F.col("c_custkey")
    segment = F.lower("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("log"),
        pick(key, *FORMATS).alias("format"),
        pick(key, *OUTPUTS).alias("output_format"),
        F.concat(F.lit("/lake/"), segment, F.lit("/")).alias("base_partition"),
        F.concat(F.lit("/c"), key.cast("string"), F.lit("/")).alias("log_partition"),
        F.when(key % 3 != 0, F.concat(F.lit("t_"), key.cast("string"))).alias("hive_table_name"),
        F.when(key % 2 != 0, F.concat(F.lit("jdbc:mariadb://db.example:3307/"), segment, F.lit("?connectTimeout=5"))).alias("hive_url"),
        F.lit("u").alias("hive_user"),
        F.lit(None).cast("string").alias("hive_password"),
        F.lit("/q").alias("quarantine"),
        pick(key, *LAYOUTS).alias("date_format"),
        F.col("c_mktsegment").alias("log_group"),
        F.when(F.col("c_acctbal") > 0, F.lit(1)).otherwise(F.lit(0)).alias("enabled"),
    )


CUSTOMER_CATALOG_SQL = f"""
    SELECT c_name AS log,
           {pick_sql('c_custkey', *FORMATS)} AS format,
           {pick_sql('c_custkey', *OUTPUTS)} AS output_format,
           '/lake/' || lower(c_mktsegment) || '/' AS base_partition,
           '/c' || c_custkey || '/' AS log_partition,
           CASE WHEN c_custkey % 3 <> 0 THEN 't_' || c_custkey END AS hive_table_name,
           CASE WHEN c_custkey % 2 <> 0 THEN 'jdbc:mariadb://db.example:3307/' || lower(c_mktsegment) || '?connectTimeout=5' END AS hive_url,
           'u' AS hive_user, CAST(NULL AS VARCHAR) AS hive_password, '/q' AS quarantine,
           {pick_sql('c_custkey', *LAYOUTS)} AS date_format,
           c_mktsegment AS log_group,
           CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS enabled
    FROM customer"""
