"""Key and name queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillflow.functions import keys
from rillflow.queries import Registry
from rillflow.queries.feeds import events, pick, pick_sql, table

QUERIES = Registry()


@QUERIES.add("""
    SELECT event_id, strftime(ts, '%Y-%m-%d-%H') AS hour, event_type || '-' || strftime(ts, '%Y-%m-%d-%H') AS topic_hour,
           strftime(ts, '%Y%m%d%H%M') AS minute FROM events""")
def hour_keys(spark, sf_dir):
    ts = F.col("ts")
    return events(spark, sf_dir).select(
        "event_id", keys.hour_key(ts).alias("hour"),
        keys.topic_hour_key(F.col("event_type"), ts).alias("topic_hour"),
        keys.minute_key(ts).alias("minute"),
    )


@QUERIES.add("SELECT p_partkey, CASE WHEN p_size < 10 THEN '0' ELSE '' END || p_size AS padded FROM part")
def zero_padded(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", keys.zero_pad(F.col("p_size")).alias("padded"))


def _file_name():
    """File names of every shape, one per event, below a folder."""
    ts = keys.hour_key(F.col("ts"))
    t, ms = F.col("event_type"), F.col("ms").cast("string")
    shapes = [
        F.concat(t, F.lit("-"), ts, F.lit(".gz")),
        F.concat(t, F.lit("-"), ts, F.lit("."), ms, F.lit(".gz")),
        F.concat(F.lit("my-"), t, F.lit("-"), ts, F.lit("-2020-01-01-00.parquet")),
        F.concat(t, F.lit(".gz")),
        F.concat(t, F.lit("-9"), ts, F.lit(".gz")),
    ]
    name = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, shape in enumerate(shapes):
        name = name.when(F.col("event_id") % len(shapes) == i, shape)
    return F.concat(F.lit("/data/in/"), name)


_FILES_SQL = """
    h AS (SELECT event_id, event_type AS t, event_id % 5 AS k, epoch_us(ts) // 1000 AS ms, ts,
                 strftime(ts, '%Y-%m-%d-%H') AS h FROM events),
    f AS (SELECT *, CASE k WHEN 0 THEN t || '-' || h || '.gz' WHEN 1 THEN t || '-' || h || '.' || ms || '.gz'
                    WHEN 2 THEN 'my-' || t || '-' || h || '-2020-01-01-00.parquet' WHEN 3 THEN t || '.gz'
                    ELSE t || '-9' || h || '.gz' END AS name FROM h)"""


@QUERIES.add(f"""
    WITH {_FILES_SQL}
    SELECT event_id, CASE WHEN k < 3 THEN h END AS hour,
           CASE k WHEN 2 THEN 'my-' || t || '-' || h WHEN 3 THEN NULL ELSE t END AS topic FROM f""")
def file_name_parts(spark, sf_dir):
    """The hour is the first one in the name, the topic stands before the last one."""
    df = events(spark, sf_dir).withColumn("path", _file_name())
    return df.select("event_id", keys.file_hour(F.col("path")).alias("hour"), keys.file_topic(F.col("path")).alias("topic"))


_BASES = ("/log/base", "/log/base/", "base//")
_PARTS = ("part", "/part", "part/", "/a/b/", None)
_LAYOUTS = ("datehour", "date", None, "other")


@QUERIES.add(f"""
    WITH {_FILES_SQL},
    d AS (SELECT event_id, name, h, ts, k, {pick_sql('event_id', *_LAYOUTS)} AS layout,
                 {pick_sql('event_id', '/log/base', '/log/base', 'base/')} AS base,
                 {pick_sql('event_id', 'part', 'part', 'part', 'a/b', None)} AS part FROM f)
    SELECT event_id, CASE WHEN k < 3 THEN
        base || '/' || part || '/date=' || strftime(ts, '%Y%m%d') ||
        CASE WHEN layout = 'datehour' THEN '/hour=' || strftime(ts, '%Y%m%d%H') ELSE '' END ||
        '/host1-' || name END AS destination
    FROM d""")
def dest_paths(spark, sf_dir):
    key = F.col("event_id")
    path = keys.destination_path(pick(key, *_BASES), pick(key, *_PARTS), pick(key, *_LAYOUTS), F.lit("host1"), _file_name())
    return events(spark, sf_dir).select("event_id", path.alias("destination"))


@QUERIES.add("""
    SELECT page_id,
           CASE WHEN starts_with(p, '/') THEN substr(p, 2) ELSE p END AS no_first,
           CASE WHEN ends_with(p, '/') THEN substr(p, 1, length(p) - 1) ELSE p END AS no_last
    FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/' || url || '//' ELSE url END AS p FROM pages)""")
def stripped_slashes(spark, sf_dir):
    df = table(spark, sf_dir, "pages")
    path = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/"), "url", F.lit("//"))).otherwise(F.col("url"))
    return df.select("page_id", keys.strip_first_slash(path).alias("no_first"), keys.strip_last_slash(path).alias("no_last"))


@QUERIES.add("""
    SELECT o_orderkey, 'dt=' || strftime(o_orderdate, '%Y%m%d') || ',hr=' || strftime(o_orderdate, '%Y%m%d%H') AS spec
    FROM orders""")
def partition_specs(spark, sf_dir):
    hour = keys.hour_key(F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf_dir, "orders").select("o_orderkey", keys.partition_spec(hour).alias("spec"))


@QUERIES.add("SELECT doc_id, replace(lang || '-' || source || '-log', '-', '_') AS table_name FROM documents")
def table_names(spark, sf_dir):
    topic = F.concat_ws("-", "lang", "source", F.lit("log"))
    return table(spark, sf_dir, "documents").select("doc_id", keys.table_name(topic).alias("table_name"))


@QUERIES.add("SELECT c_custkey, c_name AS db FROM customer")
def jdbc_databases(spark, sf_dir):
    key, name = F.col("c_custkey"), F.col("c_name")
    url = (
        F.when(key % 4 == 0, F.concat(F.lit("jdbc:mariadb:sequential://one.example:3307,two.example:3308/"), name))
        .when(key % 4 == 1, F.concat(F.lit("jdbc:hive2://lake.example:10000/"), name, F.lit("?connectTimeout=5")))
        .when(key % 4 == 2, F.concat(F.lit("jdbc:postgresql://pg.example/"), name, F.lit("?user=reader&sslmode=require")))
        .otherwise(F.concat(F.lit("//host:10000/"), name, F.lit(";a=b")))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", keys.jdbc_database(url).alias("db"))


@QUERIES.add("""
    SELECT event_id, strftime(ts, '%Y%m%d') AS date, strftime(ts, '%Y%m%d%H') AS hour,
           '/lake/' || event_type || '/date=' || strftime(ts, '%Y%m%d') || '/hour=' || strftime(ts, '%Y%m%d%H') AS hourly_dir,
           '/lake/' || event_type || '/date=' || strftime(ts, '%Y%m%d') AS daily_dir
    FROM events""")
def lake_columns(spark, sf_dir):
    ts, topic = F.col("ts"), F.col("event_type")
    return events(spark, sf_dir).select(
        "event_id", keys.day_dir(ts).alias("date"), keys.hour_dir(ts).alias("hour"),
        keys.lake_dir(F.lit("/lake/"), topic, F.lit("datehour"), ts).alias("hourly_dir"),
        keys.lake_dir(F.lit("/lake/"), topic, F.lit("date"), ts).alias("daily_dir"),
    )
