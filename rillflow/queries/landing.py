"""Write-then-read queries: landed files, the lake, tables, partitions, audit rows."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow.functions.keys import file_hour, file_topic
from rillflow.operators import metrics, tables
from rillflow.operators.catalog import PublishDefaults
from rillflow.operators.parse import parse_messages, parse_with_descriptor
from rillflow.operators.quality import keyed_rows, split_by_error, with_hour_key
from rillflow.plans import named_files as named, versions
from rillflow.plans.ingest import IngestPipeline, IngestPlan, parsed_rows, run_ingest
from rillflow.plans.publish import landed_batches, publish_batches, publish_settings, register_partitions, remove_published
from rillflow.queries import Registry
from rillflow.queries.feeds import (
    bytes_of,
    event_catalog,
    event_messages,
    events,
    landing_catalog,
    parsed_events,
    table,
)
from rillflow.session import ROLLOVER_BYTES, work_dir
from rillflow.sinks import lake, landing, reports
from rillflow.sources import files
from rillflow.sources.store import make_folder, move

QUERIES = Registry()

_LINE = "concat_ws('|', event_id, user_id, event_type)"
_LANDED_SQL = f"SELECT event_type AS topic, strftime(ts, '%Y-%m-%d-%H') AS hour, {_LINE} AS line FROM events"


@QUERIES.add(_LANDED_SQL)
def text_roundtrip(spark, sf_dir):
    """Lines by topic and hour, gzip, written and read back with their directories."""
    path = work_dir(spark, "text")
    landing.land_text(with_hour_key(parsed_events(spark, sf_dir)), path)
    return spark.read.schema(landing.LANDED_TEXT_SCHEMA).text(path).select("topic", "hour", F.col("value").alias("line"))


@QUERIES.add(f"SELECT {_LINE} AS value FROM events")
def landed_lines(spark, sf_dir):
    path = work_dir(spark, "lines")
    landing.land_text(with_hour_key(parsed_events(spark, sf_dir)), path, codec="none", writers=2)
    return files.read_landed_lines(spark, path)


@QUERIES.add("""
    SELECT event_type AS topic, strftime(ts, '%Y-%m-%d-%H') AS hour, event_id, user_id, event_type AS name FROM events""")
def parquet_roundtrip(spark, sf_dir):
    """Columns matched to a table schema by name and cast, gzip pages."""
    path = work_dir(spark, "parquet")
    rows = with_hour_key(parsed_events(spark, sf_dir)).select(
        "topic", "hour", F.get("fields", F.lit(2)).alias("NAME"), F.get("fields", F.lit(0)).alias("Event_Id"), F.get("fields", F.lit(1)).alias("USER_ID"),
    )
    schema = tables.write_schema(StructType.fromDDL("EVENT_ID bigint, user_id bigint, name string, dt string, hr string"))
    landing.land_parquet(rows, path, schema)
    return spark.read.parquet(path).withColumn("hour", F.col("hour").cast("string"))


@QUERIES.add(f"""
    SELECT CASE event_type WHEN 'click' THEN 'gzip' WHEN 'error' THEN 'none' WHEN 'purchase' THEN 'snappy'
           WHEN 'signup' THEN 'bzip2' ELSE 'parquet' END AS codec, event_type AS topic, {_LINE} AS line FROM events""")
def codec_landing(spark, sf_dir):
    """The default pipeline: each topic landed with the codec of its output format."""
    path = work_dir(spark, "landing")
    run_ingest(event_messages(spark, sf_dir), landing_catalog(spark), IngestPlan(path))
    text = spark.read.text(f"{path}/text").select("codec", "topic", F.col("value").alias("line"))
    columnar = spark.read.parquet(f"{path}/parquet")
    return text.unionByName(columnar.select(F.lit("parquet").alias("codec"), "topic", F.array_join("fields", "|").alias("line")))


@QUERIES.add(f"""
    SELECT strftime(ts, '%Y%m%d') AS date, strftime(ts, '%Y%m%d%H') AS hour, event_id, event_type AS topic FROM events""")
def lake_hourly(spark, sf_dir):
    root = work_dir(spark, "lake")
    rows = lake.with_layout(events(spark, sf_dir), "datehour").select("event_id", F.col("event_type").alias("topic"), "date", "hour")
    lake.write_lake(rows, root + "/", "/events/", "datehour")
    return lake.read_lake(spark, root, "events", "datehour", "event_id bigint, topic string")


@QUERIES.add("""
    SELECT strftime(ts, '%Y%m%d') AS date, event_id, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 'again' ELSE event_type END AS status
    FROM events""")
def lake_daily(spark, sf_dir):
    """A daily lake; publishing some days again replaces exactly those days."""
    root = work_dir(spark, "lake")
    rows = lake.with_layout(events(spark, sf_dir), "date").select("event_id", F.col("event_type").alias("status"), "date")
    lake.write_lake(rows, root, "daily", None)
    again = rows.filter(F.col("date") >= "20240120").withColumn("status", F.lit("again"))
    lake.write_lake(again, root, "daily", "other", replace_touched=True)
    return lake.read_lake(spark, root, "daily", "date", "event_id bigint, status string")


@QUERIES.add("""
    SELECT event_type AS topic, error, count(*) AS n, count(DISTINCT line) AS n_lines FROM (
        SELECT *, concat_ws('|', event_id, user_id, event_type, epoch_us(ts) // 1000) AS line,
               CASE event_type WHEN 'error' THEN 'time field is not a time' WHEN 'view' THEN 'no parser for format type json'
                    ELSE 'format names no ts, ts_ms or ts_sec field' END AS error
        FROM events WHERE event_type IN ('error', 'signup', 'view')) GROUP BY 1, 2""")
def quarantine_written(spark, sf_dir):
    """Bad rows below a quarantine folder with their bytes and error."""
    root = work_dir(spark, "quarantine")
    bad = split_by_error(parse_messages(event_messages(spark, sf_dir), event_catalog(spark))).bad
    rows = bad.select("topic", "value", "error").withColumn("received", F.current_timestamp())
    lake.write_quarantine(rows, root, "bad")
    stored = lake.read_lake(spark, root, "bad", "datehour", "topic string, value binary, error string")
    return stored.groupBy("topic", "error").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("value").alias("n_lines"))


def _land_all(spark, sf_dir, label):
    """Every event landed as text, in two batches of different codecs."""
    path = work_dir(spark, label)
    rows = with_hour_key(parsed_events(spark, sf_dir))
    for batch, codec, of_view in (("0", "gzip", False), ("1", "none", True)):
        mine = rows.filter((F.col("topic") == "view") == of_view)
        landing.land_by_codec(mine.withColumn("codec", F.lit(codec)), path, run="events", batch=batch)
    return path


def _publish_catalog(spark, root, database):
    from rillflow.operators.catalog import make_catalog

    url = f"jdbc:hive2://lake.example:10000/{database}"
    return make_catalog(spark, [
        {"log": "click", "base_partition": f"{root}/a/", "log_partition": "/click", "hive_table_name": "t_click", "hive_url": url},
        {"log": "purchase", "base_partition": f"{root}/b", "log_partition": "sales", "date_format": "date", "hive_url": url},
        {"log": "view", "base_partition": f"{root}/a", "log_partition": "view", "hive_url": ""},
    ])


_PUBLISHED_SQL = f"""
    SELECT CASE event_type WHEN 'click' THEN 'a/click' WHEN 'purchase' THEN 'b/sales' WHEN 'view' THEN 'a/view'
                ELSE 'default/' || event_type END AS place,
           strftime(ts, '%Y%m%d') AS date,
           CASE WHEN event_type <> 'purchase' THEN strftime(ts, '%Y%m%d%H') END AS hour, {_LINE} AS line
    FROM events"""


def _published(spark, root):
    """Everything in the lake, with place and directory columns taken from the paths."""
    lines = spark.read.option("recursiveFileLookup", True).text(root)
    path = F.col("_metadata.file_path")
    part = lambda pattern: F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
    return lines.select(
        part(r"/([a-z]+/[a-z]+)/date=").alias("place"), part("/date=([0-9]+)/").alias("date"),
        part("/hour=([0-9]+)/").alias("hour"), F.col("value").alias("line"),
    )


@QUERIES.add(_PUBLISHED_SQL)
def publish_lake(spark, sf_dir):
    """Landed batches to the lake by catalog; publishing one of them again changes nothing."""
    path = _land_all(spark, sf_dir, "landing")
    root = work_dir(spark, "lake")
    catalog = _publish_catalog(spark, root, "unused")
    batches = landed_batches(spark, path)
    for chosen in (batches, batches[1:]):
        publish_batches(spark, path, chosen, catalog, PublishDefaults(base_partition=f"{root}/default")).unpersist()
    return _published(spark, root)


@QUERIES.add(f"""
    SELECT 'default/events' AS place, strftime(ts, '%Y%m%d') AS date, strftime(ts, '%Y%m%d%H') AS hour, {_LINE} AS line FROM events""")
def publish_late_rows(spark, sf_dir):
    """Half of every hour published, the landing folder cleaned, then the late half: all rows are in the lake."""
    path, root = work_dir(spark, "landing"), work_dir(spark, "lake")
    rows = with_hour_key(parsed_events(spark, sf_dir)).withColumns({"codec": F.lit("gzip"), "topic": F.lit("events")})
    for batch in range(2):
        landing.land_by_codec(rows.filter(F.col("event_id") % 2 == batch), path, run="events", batch=str(batch))
        publish_batches(spark, path, landed_batches(spark, path), event_catalog(spark), PublishDefaults(base_partition=f"{root}/default")).unpersist()
        remove_published(spark, path)
    return _published(spark, root)


@QUERIES.add(f"""
    SELECT 'all/one' AS place, strftime(ts, '%Y%m%d') AS date,
           CASE WHEN event_type IN ('error', 'signup', 'view') THEN strftime(ts, '%Y%m%d%H') END AS hour, {_LINE} AS line FROM events""")
def publish_shared_destination(spark, sf_dir):
    """Topics with daily, hourly and other layouts, and one without a catalog row, in one directory keep each other's files."""
    from rillflow.operators.catalog import make_catalog

    path, root = work_dir(spark, "landing"), work_dir(spark, "lake")
    layouts = {"click": "date", "purchase": "other", "signup": "datehour", "error": "datehour"}
    catalog = make_catalog(spark, [{"log": t, "base_partition": f"{root}/all/", "log_partition": "/one", "date_format": f} for t, f in layouts.items()])
    rows = with_hour_key(parsed_events(spark, sf_dir)).withColumn("codec", F.lit("gzip"))
    # The topic without a row is published under its own name, here the shared one.
    named = rows.withColumn("topic", F.when(F.col("topic") == "view", F.lit("one")).otherwise(F.col("topic")))
    landing.land_by_codec(named, path, run="events")
    publish_batches(spark, path, landed_batches(spark, path), catalog, PublishDefaults(base_partition=f"{root}/all")).unpersist()
    return _published(spark, root)


@QUERIES.add("""
    SELECT log, status, count(*) AS n FROM (
        SELECT DISTINCT event_type AS log, CASE event_type WHEN 'click' THEN 'ok' ELSE 'error' END AS status, date_trunc('hour', ts) AS h
        FROM events WHERE event_type IN ('click', 'purchase')) GROUP BY 1, 2""")
def register_with_missing_table(spark, sf_dir):
    """One of two tables is missing: its partitions are reported, the other's registered."""
    root = work_dir(spark, "lake")
    database = "rf_" + root.rsplit("-", 1)[1]
    tables.create_database(spark, database, f"{root}/db")
    tables.create_landing_table(spark, f"{database}.t_click", "value string", "text")
    hours = metrics.topic_hour_counts(keyed_rows(with_hour_key(parsed_events(spark, sf_dir)))).select("topic", "hour")
    audit = register_partitions(spark, publish_settings(hours, _publish_catalog(spark, root, database)))
    return audit.groupBy("log", "status").agg(F.count("*").alias("n"))


@QUERIES.add("""
    SELECT 't_click' AS name, strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%Y%m%d%H') AS hr, count(*) AS n
    FROM events WHERE event_type = 'click' GROUP BY ALL
    UNION ALL
    SELECT 'purchase', d, h, n
    FROM (SELECT DISTINCT strftime(ts, '%Y%m%d') AS d, strftime(ts, '%Y%m%d%H') AS h FROM events WHERE event_type = 'purchase')
    JOIN (SELECT strftime(ts, '%Y%m%d') AS d, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1) USING (d)""")
def registered_partitions(spark, sf_dir):
    """Published directories registered with two tables and read through them. A
    daily topic has a partition per hour, each at its day's directory."""
    path = _land_all(spark, sf_dir, "landing")
    root = work_dir(spark, "lake")
    database = "rf_" + root.rsplit("-", 1)[1]
    tables.create_database(spark, database, f"{root}/db")
    for name in ("t_click", "purchase"):
        tables.create_landing_table(spark, f"{database}.{name}", "value string", "text")
    catalog = _publish_catalog(spark, root, database)
    settings = publish_batches(spark, path, landed_batches(spark, path), catalog, PublishDefaults(base_partition=f"{root}/default"))
    register_partitions(spark, settings)
    settings.unpersist()
    counted = [
        spark.table(f"{database}.{name}").groupBy(F.lit(name).alias("name"), "dt", "hr").agg(F.count(F.lit(1)).alias("n"))
        for name in ("t_click", "purchase")
    ]
    return counted[0].unionAll(counted[1])


@QUERIES.add("""
    SELECT * FROM (VALUES ('l_orderkey', 'bigint'), ('l_quantity', 'double'), ('l_returnflag', 'string')) c(col_name, data_type),
        (SELECT count(*) AS n FROM lineitem)""")
def described_table(spark, sf_dir):
    """Data columns of a table described without its partition columns, beside its rows."""
    root = work_dir(spark, "db")
    database = "rf_" + root.rsplit("-", 1)[1]
    tables.create_database(spark, database, root)
    name = f"{database}.lines"
    tables.create_landing_table(spark, name, "L_ORDERKEY bigint, l_quantity double, L_ReturnFlag string")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    location = f"{root}/files"
    rows.write.parquet(location)
    tables.add_partitions(spark, name, [("20240101", "2024010100", location)])
    count = spark.table(name).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return tables.described_columns(spark, name).withColumn("n", F.lit(count))


@QUERIES.add("""
    SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS partkey, CAST(NULL AS BIGINT) AS absent, l_returnflag AS flag, l_linenumber AS line
    FROM lineitem""")
def conformed_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias(" FLAG "), F.col("l_linenumber").cast("string").alias("Line"),
        F.col("l_partkey").alias("PartKey"), "l_orderkey", F.lit("x").alias("dt"),
    )
    schema = tables.write_schema(StructType.fromDDL("L_ORDERKEY bigint, partkey string, absent bigint, flag string, LINE int, dt string, hr string"))
    return tables.conform(rows, schema)


@QUERIES.add("""
    SELECT source AS topic, list_filter(string_split(text, ' '), lambda x: x <> '')[1] AS "searchField" FROM documents""")
def search_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("topic"), bytes_of(F.col("text")).alias("value"))
    return reports.search_documents(parse_with_descriptor(docs, "txt:sep=space;ts=-1"))


@QUERIES.add("""
    SELECT '2024-02-01' AS push_ts, event_type AS log_name, event_type || '-' || strftime(ts, '%Y-%m-%d-%H') || '.gz' AS file_name,
           '/lake/' || event_type AS dir, 'h1' AS host, count(*) AS file_size, 'complete' AS status
    FROM events GROUP BY ALL""")
def file_audit(spark, sf_dir):
    """An audit row per published file; a file's size here is its number of messages."""
    path = work_dir(spark, "audit")
    counts = metrics.topic_hour_counts(keyed_rows(with_hour_key(parsed_events(spark, sf_dir))))
    name = F.concat(F.lit("/lake/"), "topic", F.lit("/"), "topic", F.lit("-"), "hour", F.lit(".gz"))
    listing = counts.select("topic", name.alias("path"), F.col("messages").alias("length"))
    audit = reports.file_audit(listing, F.col("topic"), F.lit("h1"), F.lit("complete"), F.lit("2024-02-01").cast("timestamp_ntz"))
    reports.append_audit(audit, path)
    return spark.read.parquet(path).withColumn("push_ts", F.date_format("push_ts", "yyyy-MM-dd"))


@QUERIES.add("""
    SELECT DISTINCT '2024-02-01' AS ts, event_type AS log, 'dt=' || strftime(ts, '%Y%m%d') || ',hr=' || strftime(ts, '%Y%m%d%H') AS "partition",
           CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, CASE WHEN event_type = 'error' THEN 'no table' END AS exception
    FROM events""")
def partition_audit(spark, sf_dir):
    hours = lake.with_layout(parsed_events(spark, sf_dir), "datehour").select("topic", F.col("date").alias("dt"), F.col("hour").alias("hr")).distinct()
    failure = F.when(F.col("topic") == "error", F.lit("no table"))
    audit = reports.partition_audit(hours, failure, F.lit("2024-02-01").cast("timestamp_ntz"))
    return audit.withColumn("ts", F.date_format("ts", "yyyy-MM-dd"))


@QUERIES.add("""
    SELECT event_type AS topic, strftime(ts, '%Y-%m-%d-%H') AS hour, count(*) AS messages FROM events GROUP BY 1, 2""")
def messages_per_file(spark, sf_dir):
    """Messages counted per landed file, then added up per topic and hour."""
    path = work_dir(spark, "counted")
    landing.land_text(with_hour_key(parsed_events(spark, sf_dir)), path, max_records=500)
    lines = spark.read.text(path)
    per_file = metrics.messages_per_file(lines)
    topic = F.regexp_extract("file", "/topic=([^/]+)/", 1)
    hour = F.regexp_extract("file", "/hour=([^/]+)/", 1)
    return per_file.groupBy(topic.alias("topic"), hour.alias("hour")).agg(F.sum("messages").alias("messages"))


@QUERIES.add(f"""
    SELECT count(DISTINCT event_type || strftime(ts, '%Y%m%d%H')) AS files, CAST(sum(strlen({_LINE}) + 1) AS BIGINT) AS bytes FROM events""")
def upload_meters(spark, sf_dir):
    """Files and bytes of the landed data, after the integrity check: here a plain file per topic and hour."""
    path = work_dir(spark, "metered")
    landing.land_text(with_hour_key(parsed_events(spark, sf_dir)), path, codec="none", writers=1)
    return metrics.file_meters(files.check_files(files.list_files(spark, path, "part-*"), path).filter("file_ok"))


@QUERIES.add(f"""
    SELECT CASE WHEN event_type = 'click' THEN 'bzip2' ELSE 'gzip' END AS codec, event_type AS topic, {_LINE} AS line
    FROM events WHERE event_type IN ('click', 'purchase')
    UNION ALL
    SELECT 'no sink for codec zip', event_type, NULL FROM events WHERE event_type = 'signup'""")
def codec_from_plugin(spark, sf_dir):
    """Codecs that only a plugin sets: known ones are landed, an unknown one comes back with its reason."""
    from rillflow.plans.pipelines import ColumnPlugin

    path = work_dir(spark, "landing")
    codec = F.when(F.col("topic") == "click", F.lit("bzip2")).when(F.col("topic") == "signup", F.lit("zip")).otherwise(F.lit("gzip"))
    plan = IngestPlan(path, {"plugins": {"pack": ColumnPlugin(lambda columns: {"codec": codec})}, "pipeline": ["->", "pack", "disk-writer"]})
    messages = event_messages(spark, sf_dir).filter(F.col("topic").isin("click", "purchase", "signup"))
    bad = run_ingest(messages, landing_catalog(spark), plan)
    landed = spark.read.text(f"{path}/text").select("codec", "topic", F.col("value").alias("line"))
    return landed.unionByName(bad.select(F.col("error").alias("codec"), "topic", F.lit(None).cast("string").alias("line")))


@QUERIES.add("""
    SELECT event_type AS topic, strftime(ts, '%Y-%m-%d-%H') AS hour, count(*) AS n FROM events GROUP BY 1, 2""")
def named_files(spark, sf_dir):
    """Topic and hour of landed rows recovered from file names of the usual shape."""
    ts = F.date_format("ts", "yyyy-MM-dd-HH")
    name = F.concat(F.lit("/in/"), F.col("event_type"), F.lit("-"), ts, F.lit(".gz"))
    df = events(spark, sf_dir).select(name.alias("file"))
    return df.groupBy(file_topic(F.col("file")).alias("topic"), file_hour(F.col("file")).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@QUERIES.add(f"""
    SELECT event_type AS type, strftime(ts, '%Y-%m-%d-%H') AS hour, {_LINE} AS message FROM events
    WHERE event_type IN ('click', 'purchase') AND event_type <> 'purchase'
    UNION ALL SELECT 'sale', strftime(ts, '%Y-%m-%d-%H'), CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'purchase'""")
def ingest_with_plugins(spark, sf_dir):
    """Parsed rows through a pipeline that retags one topic."""
    from rillflow.plans.pipelines import Retag

    catalog = event_catalog(spark)
    good = split_by_error(parsed_rows(event_messages(spark, sf_dir), catalog)).good
    plan = IngestPlan("unused", {"plugins": {"sale": Retag("sale")}, "pipeline": ["->", ["match", "purchase", "sale"]]})
    return IngestPipeline(plan).apply(good)[0].select("type", "hour", "message")


def _place_columns(root):
    """Place below ``root``, date and hour of a published directory."""
    part = lambda pattern: F.nullif(F.regexp_extract("place", pattern, 1), F.lit(""))
    return [part(r"/([a-z]+/[a-z]+)/date=").alias("place"), part("/date=([0-9]+)").alias("date"), part("/hour=([0-9]+)").alias("hour")]


def _daily_catalog(root, spark, **base):
    """Topics by day; ``base`` gives a topic another base."""
    from rillflow.operators.catalog import make_catalog

    topics = ("click", "error", "purchase", "signup", "view")
    return make_catalog(spark, [{"log": t, "base_partition": f"{root}/{base.get(t, 'days')}", "log_partition": "all", "date_format": "date", "quarantine": f"{root}/quarantine"} for t in topics])


def _event_increments(spark, sf_dir):
    rows = with_hour_key(parsed_events(spark, sf_dir)).select("topic", "hour", "event_id", F.col("message").alias("value"))
    return rows, rows.select("topic", "hour").distinct()


@QUERIES.add(f"""
    SELECT 'days/all' AS place, strftime(ts, '%Y%m%d') AS date, CAST(NULL AS VARCHAR) AS hour, {_LINE} AS line, CAST(0 AS BIGINT) AS seen_half_way FROM events""")
def publish_at_once(spark, sf_dir):
    """A publisher that stops with all files written and none in the manifest, then runs again: readers see none, then all once."""
    root = work_dir(spark, "lake")
    rows, hours = _event_increments(spark, sf_dir)
    catalog = _daily_catalog(root, spark)
    versions.write_increment(rows.drop("event_id"), hours, catalog, f"{root}/log", "first")
    half_way = versions.read_published(spark, f"{root}/log").count()
    versions.publish_increment(rows.drop("event_id"), hours, catalog, f"{root}/log", "first")
    versions.remove_unseen(spark, f"{root}/log", unfinished=True)
    seen = versions.read_published(spark, f"{root}/log")
    return seen.select(*_place_columns(root), F.col("value").alias("line"), F.lit(half_way).alias("seen_half_way"))


@QUERIES.add(f"""
    SELECT CASE event_type WHEN 'click' THEN 'moved/all' ELSE 'days/all' END AS place, strftime(ts, '%Y%m%d') AS date, {_LINE} AS line FROM events""")
def publish_moved(spark, sf_dir):
    """A publication run again after the catalog has moved a topic: its rows are at the new place alone, and no old file is left."""
    root = work_dir(spark, "lake")
    rows, hours = _event_increments(spark, sf_dir)
    for catalog in (_daily_catalog(root, spark), _daily_catalog(root, spark, click="moved")):
        versions.publish_increment(rows.drop("event_id"), hours, catalog, f"{root}/log", "events")
    versions.remove_unseen(spark, f"{root}/log")
    # Read from the store, not through the manifest: what is on it is what is published.
    seen = versions.live_files(spark, f"{root}/log").select(versions.own_path(F.col("path")).alias("own"), "place")
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "part-*.txt.gz").text([f"{root}/{base}/{versions.FILES}" for base in ("days", "moved")])
    stored = lines.select(versions.own_path(F.col("_metadata.file_path")).alias("own"), F.col("value").alias("line"))
    return stored.join(seen, "own", "left").select(*_place_columns(root)[:2], "line")


@QUERIES.add(f"""
    SELECT strftime(ts, '%Y%m%d') AS date, count(*) AS n, count(DISTINCT {_LINE}) AS n_lines, true AS few_files, CAST(sum(event_id) AS BIGINT) AS ids
    FROM events GROUP BY 1""")
def publish_compacted(spark, sf_dir):
    """Twenty increments joined, the last of them published while the others are being joined, then joined as well.

    Files of a day: as many as its bytes need, and one more for the late increment before the second round.
    """
    root = work_dir(spark, "lake")
    log = f"{root}/log"
    rows, _ = _event_increments(spark, sf_dir)
    catalog = _daily_catalog(root, spark)
    for i in range(20):
        if i == 19:
            first = versions.write_compaction(spark, log)
        mine = rows.where(F.col("event_id") % 20 == i).drop("event_id")
        versions.publish_increment(mine, mine.select("topic", "hour").distinct(), catalog, log, f"part-{i}", writers=1)
    versions.commit(first)
    between = versions.live_files(spark, log).groupBy("place").agg(F.count("*").alias("between"))
    versions.compact(spark, log)
    versions.remove_unseen(spark, log)
    files = versions.live_files(spark, log).groupBy("place").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    few = files.join(between, "place").select("place", ((F.col("files") == F.ceil(F.col("bytes") / F.lit(ROLLOVER_BYTES))) & (F.col("between") <= F.col("files") + 1)).alias("few_files"))
    lines = versions.read_published(spark, log).join(F.broadcast(few), "place")
    return lines.groupBy(_place_columns(root)[1], "few_files").agg(
        F.count("*").alias("n"), F.count_distinct("value").alias("n_lines"), F.sum(F.split_part("value", F.lit("|"), F.lit(1)).cast("bigint")).alias("ids")
    )


@QUERIES.add("""
    SELECT strftime(ts, '%Y%m%d') AS dt, count(*) AS n, 'ok' AS status FROM events WHERE event_type = 'click' GROUP BY 1""")
def switched_partitions(spark, sf_dir):
    """A table's days in two folders wait, are joined whole, and the table is switched to the joined folders."""
    from rillflow.operators.catalog import make_catalog

    root = work_dir(spark, "lake")
    log, database = f"{root}/log", "rf_" + root.rsplit("-", 1)[1]
    tables.create_database(spark, database, f"{root}/db")
    tables.create_landing_table(spark, f"{database}.t_click", "value string", "text")
    catalog = make_catalog(spark, [{
        "log": "click", "base_partition": f"{root}/days", "log_partition": "all", "date_format": "date", "hive_table_name": "t_click",
        "hive_url": f"jdbc:hive2://lake.example:10000/{database}",
    }])
    rows, _ = _event_increments(spark, sf_dir)
    rows = rows.where("topic = 'click'")
    settings = publish_settings(rows.select("topic", "hour").distinct(), catalog)
    for i in range(2):
        mine = rows.where(F.col("event_id") % 2 == i).drop("event_id")
        versions.publish_increment(mine, mine.select("topic", "hour").distinct(), catalog, log, f"half-{i}", writers=1)
        versions.switch_partitions(spark, log, settings, pause=0)
    versions.compact(spark, log, whole=True)
    told = versions.switch_partitions(spark, log, settings, pause=0).groupBy("dt").agg(F.max("status").alias("status"), F.min("hr").alias("hr"))
    # A row for each day: Spark knows no size of it and would broadcast the table's lines.
    return spark.table(f"{database}.t_click").join(F.broadcast(told), ["dt", "hr"]).groupBy("dt", "status").agg(F.count("*").alias("n"))


def _put(spark, rows, target, fmt="text"):
    """One file of the given rows under a name of its own."""
    staged = work_dir(spark, "put")
    rows.coalesce(1).write.option("compression", "gzip" if target.endswith(".gz") else "none").format(fmt).save(staged)
    part = files.list_files(spark, staged, "part-*").unionByName(files.empty_files(spark, staged)).filter("path LIKE '%/part-%'").first()
    move(spark, part["path"], target)


def _named_feed(spark, sf_dir, root):
    """A finished gzip file per topic and day below ``root``; a corrupt and an empty Parquet file for each topic, one of no topic."""
    make_folder(spark, root)
    staged = work_dir(spark, "finished")
    rows = with_hour_key(parsed_events(spark, sf_dir)).withColumn("hour", F.concat(F.substring("hour", 1, 10), F.lit("-00")))
    landing.land_text(rows, staged, writers=1)
    for row in files.list_files(spark, staged, "part-*").select("path").toLocalIterator():
        topic, hour = (part.split("=")[1] for part in row["path"].split("/")[-3:-1])
        move(spark, row["path"], f"{root}/{topic}-{hour}.gz")
    topics = [r["topic"] for r in rows.select("topic").distinct().collect()]
    for topic in topics:
        _put(spark, spark.range(1).select(F.lit("PAR1 is not all").alias("value")), f"{root}/{topic}-2024-01-01-00.parquet")
        _put(spark, spark.range(0).select(F.lit("").alias("value")), f"{root}/{topic}-2024-01-02-00.parquet")
    _put(spark, spark.range(1).select(F.lit("line").alias("value")), f"{root}/noname.gz")


@QUERIES.add("""
    WITH n AS (SELECT event_type AS topic, count(DISTINCT strftime(ts, '%Y%m%d')) AS files, count(*) AS lines FROM events GROUP BY 1)
    SELECT topic, 'complete' AS status, files, lines, true AS bytes_told, CAST(0 AS BIGINT) AS left_over FROM n
    UNION ALL SELECT topic, 'corrupt', 2, 0, true, 0 FROM n
    UNION ALL SELECT NULL, 'unnamed', 1, 0, true, 0""")
def published_files(spark, sf_dir):
    """Finished files published or put into quarantine once: by a round before they rested, one that is stopped, one that finishes it, and one more."""
    root, feed, log = work_dir(spark, "lake"), work_dir(spark, "feed"), work_dir(spark, "log")
    _named_feed(spark, sf_dir, feed)
    listed = files.list_files(spark, feed, files.FINISHED_GLOB).agg(F.sum("length").alias("n")).first()["n"]
    catalog = _daily_catalog(root, spark)
    defaults = PublishDefaults(base_partition=f"{root}/default", quarantine=f"{root}/quarantine")
    later = datetime.now(timezone.utc) + timedelta(hours=1)
    named.publish_named_files(spark, feed, log, catalog, defaults, wait_ms=7_200_000, now=later)
    named.begin_round(spark, feed, log, now=later)
    for _ in range(2):
        named.publish_named_files(spark, feed, log, catalog, defaults, now=later)
    meters = named.upload_meters(spark, log)
    told = meters.agg(F.sum("bytes").alias("told"))
    left = files.list_files(spark, feed, files.FINISHED_GLOB).agg(F.count("*").alias("left_over"))
    event_type = F.get(F.split("value", "[|]"), F.lit(2))
    lines = versions.read_published(spark, log).groupBy(event_type.alias("_topic")).agg(F.count("*").alias("lines"))
    counted = meters.join(lines, (F.col("topic") == F.col("_topic")) & (F.col("status") == "complete"), "left")
    return counted.join(F.broadcast(told)).join(F.broadcast(left)).select(
        "topic", "status", "files", F.coalesce("lines", F.lit(0)).alias("lines"), (F.col("told") == listed).alias("bytes_told"), "left_over"
    )


@QUERIES.add("""
    SELECT event_type || '.parquet' AS file, 'rows' AS kind, count(*) AS n, true AS file_ok FROM events GROUP BY 1
    UNION ALL SELECT DISTINCT event_type || '-none.parquet', 'no rows', 0, true FROM events
    UNION ALL SELECT DISTINCT event_type || '-cut.parquet', 'broken', 0, false FROM events
    UNION ALL SELECT DISTINCT event_type || '-void.parquet', 'empty', 0, false FROM events""")
def checked_files(spark, sf_dir):
    """Parquet files with rows and without, broken and of no bytes, told apart by one scan of their folder."""
    root = work_dir(spark, "checked")
    make_folder(spark, root)
    rows = parsed_events(spark, sf_dir).select("topic", "message", "ts")
    for topic in sorted(r["topic"] for r in rows.select("topic").distinct().collect()):
        mine = rows.filter(F.col("topic") == topic)
        _put(spark, mine, f"{root}/{topic}.parquet", "parquet")
        _put(spark, mine.filter("false"), f"{root}/{topic}-none.parquet", "parquet")
        _put(spark, spark.range(1).select(F.lit("PAR1 and no footer").alias("value")), f"{root}/{topic}-cut.parquet")
        _put(spark, spark.range(0).select(F.lit("").alias("value")), f"{root}/{topic}-void.parquet")
    listed = files.list_files(spark, root, "*.parquet").unionByName(files.empty_files(spark, root).filter("path LIKE '%.parquet'"))
    checked = files.check_files(listed, root)
    sound = spark.read.schema(mine.schema).option("ignoreCorruptFiles", True).parquet(root)
    counts = sound.groupBy(files.plain_path(F.col("_metadata.file_path")).alias("path")).agg(F.count("*").alias("n"))
    name = F.substring_index("path", "/", -1)
    kind = F.when(name.endswith("-none.parquet"), "no rows").when(name.endswith("-cut.parquet"), "broken").when(name.endswith("-void.parquet"), "empty").otherwise("rows")
    return checked.join(counts, "path", "left").select(name.alias("file"), kind.alias("kind"), F.coalesce("n", F.lit(0)).alias("n"), "file_ok")


_TABLES = {
    "click": "Event_Id bigint, Detail struct<Kind: string, User_Id: bigint, absent: int>",
    "purchase": "user_id string, event_id int",
    "signup": "DETAIL struct<kind: string, user_id: bigint, absent: int>, EVENT_ID bigint",
}


@QUERIES.add("""
    SELECT event_type AS topic, strftime(ts, '%Y-%m-%d-%H') AS hour,
           CASE event_type WHEN 'purchase' THEN 'struct<event_id:int,user_id:string>' WHEN 'view' THEN 'fields'
                ELSE 'struct<detail:struct<kind:string,user_id:bigint,absent:int>,event_id:bigint>' END AS type,
           CASE WHEN event_type = 'view' THEN NULL ELSE event_id END AS event_id, user_id, CASE WHEN event_type IN ('click', 'signup') THEN event_type END AS kind
    FROM events WHERE event_type <> 'error'""")
def typed_landing(spark, sf_dir):
    """Parquet topics landed by the schemas of their tables: two topics share one, another has its own, a fourth has no table."""
    from rillflow.operators.catalog import make_catalog
    from rillflow.plans.pipelines import ColumnPlugin

    path, root = work_dir(spark, "landing"), work_dir(spark, "db")
    database = "rf_" + root.rsplit("-", 1)[1]
    tables.create_database(spark, database, root)
    for topic, columns in _TABLES.items():
        tables.create_landing_table(spark, f"{database}.{topic}", columns)
    catalog = make_catalog(spark, [
        {"log": t, "format": "txt:sep=pipe;msg=0:3;ts=3", "output_format": "parquet", "hive_table_name": f"{database}.{t}"} for t in (*_TABLES, "view")
    ])
    schemas = tables.schemas_by_topic(catalog)

    def typed(columns):
        event_id, user_id, kind = (F.get(columns["fields"], F.lit(i)) for i in range(3))
        return {"EVENT_ID": event_id, "user_id": user_id, "detail": F.struct(user_id.alias("USER_ID"), kind.alias("kind"))}

    plan = IngestPlan(path, {"plugins": {"typed": ColumnPlugin(typed)}, "pipeline": ["->", "typed", "disk-writer"]}, schemas=schemas)
    messages = event_messages(spark, sf_dir).filter("topic <> 'error'")
    # The same run twice: its folders are replaced.
    for _ in range(2):
        run_ingest(messages, catalog, plan)
    landed = landing.landed_tables(spark, path, schemas)
    parts = []
    for fingerprint, (schema, _) in tables.schema_groups(schemas).items():
        rows = landed[fingerprint]
        nested = "detail" in schema.names
        parts.append(rows.select(
            "topic", "hour", F.lit(schema.simpleString()).alias("type"), F.col("event_id").cast("bigint").alias("event_id"),
            (F.col("detail.user_id") if nested else F.col("user_id").cast("bigint")).alias("user_id"), (F.col("detail.kind") if nested else F.lit(None).cast("string")).alias("kind"),
        ))
    other = landing.landed_parquet(spark, path, StructType.fromDDL("fields array<string>"))
    user_id = F.get("fields", F.lit(1)).cast("bigint").alias("user_id")
    parts.append(other.select("topic", "hour", F.lit("fields").alias("type"), F.lit(None).cast("bigint").alias("event_id"), user_id, F.lit(None).cast("string").alias("kind")))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found
