"""Bad-input and predicate queries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from rillflow.functions import values
from rillflow.functions.text import split_fields
from rillflow.operators import quality as ops
from rillflow.operators.catalog import disable_topics
from rillflow.operators.parse import parse_messages, parse_with_descriptor
from rillflow.queries import Registry
from rillflow.queries.feeds import bytes_of, customer_catalog, event_catalog, event_messages, events, table
from rillflow.sources.files import is_finished

QUERIES = Registry()

# Every 7th event has a broken time, every 11th too few fields.
_BROKEN_SQL = "event_id % 7 = 0 OR event_id % 11 = 0"


def _broken_messages(spark, sf_dir):
    key = F.col("event_id")
    time = F.when(key % 7 == 0, F.lit("soon")).otherwise(F.col("ms").cast("string"))
    line = F.when(key % 11 == 0, key.cast("string")).otherwise(F.concat_ws("|", "event_id", "user_id", time))
    return events(spark, sf_dir).select("event_id", F.col("event_type").alias("topic"), bytes_of(line).alias("value"))


def _parsed(spark, sf_dir):
    return parse_with_descriptor(_broken_messages(spark, sf_dir), "txt:sep=pipe;msg=0:2;ts=2")


@QUERIES.add("""
    SELECT event_id, event_type AS topic,
           CASE WHEN event_id % 11 = 0 THEN 'time field is past the last field'
                WHEN event_id % 7 = 0 THEN 'time field is not a time' END AS error,
           CASE WHEN event_id % 11 = 0 THEN CAST(event_id AS VARCHAR)
                WHEN event_id % 7 = 0 THEN concat_ws('|', event_id, user_id, 'soon')
                ELSE concat_ws('|', event_id, user_id, epoch_us(ts) // 1000) END AS line,
           CASE WHEN event_id % 11 <> 0 AND event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%d-%H') END AS hour
    FROM events""")
def quarantine_split(spark, sf_dir):
    """Good and bad rows put together again: nothing is lost and bytes are kept."""
    split = ops.split_by_error(ops.with_hour_key(_parsed(spark, sf_dir)))
    both = split.good.unionByName(split.bad)
    return both.select("event_id", "topic", "error", F.col("value").cast("string").alias("line"), "hour")


@QUERIES.add(f"""
    WITH e AS (SELECT event_type AS topic, count(*) AS errors FROM events WHERE {_BROKEN_SQL} GROUP BY 1)
    SELECT topic, errors, errors // 101 AS times_flagged, errors % 101 AS errors_left FROM e WHERE errors > 100""")
def flagged_topics(spark, sf_dir):
    return ops.flagged_topics(_parsed(spark, sf_dir))


@QUERIES.add(f"""
    WITH e AS (SELECT event_type AS topic, count(*) AS errors, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS early
               FROM events WHERE {_BROKEN_SQL} GROUP BY 1)
    SELECT topic, errors, errors // 101 AS times_flagged, errors // 101 > early // 101 AS newly_flagged FROM e""")
def errors_across_batches(spark, sf_dir):
    """Totals after two batches, the first and the second half of the month."""
    early = F.col("event_ts") < F.lit("2024-01-16").cast("timestamp")
    times = events(spark, sf_dir).select("event_id", F.col("ts").alias("event_ts"))
    parsed = _parsed(spark, sf_dir).join(times, "event_id")
    totals = spark.createDataFrame([], ops.ERROR_TOTALS_SCHEMA)
    totals = ops.add_errors(totals, ops.errors_per_topic(parsed.filter(early)))
    return ops.add_errors(totals, ops.errors_per_topic(parsed.filter(~early)))


@QUERIES.add("""
    SELECT topic, count(*) AS errors FROM (
        SELECT event_type AS topic FROM events WHERE event_type NOT IN ('click', 'purchase')) GROUP BY topic""")
def error_counts(spark, sf_dir):
    return ops.errors_per_topic(parse_messages(event_messages(spark, sf_dir), event_catalog(spark)))


@QUERIES.add("""
    WITH late AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey HAVING count(*) > 3)
    SELECT c_name AS log, CASE WHEN o_custkey IS NOT NULL THEN 0 WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS enabled
    FROM customer LEFT JOIN late ON c_custkey = o_custkey""")
def disabled_topics(spark, sf_dir):
    """The catalog after the topics with more than three failures are switched off."""
    failed = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("topic"),
        F.when(F.col("o_orderstatus") == "F", "failed").alias("error"),
    )
    flagged = ops.flagged_topics(failed, threshold=3)
    return disable_topics(customer_catalog(spark, sf_dir), flagged).select("log", "enabled")


@QUERIES.add("""
    SELECT topic, count(*) AS n FROM (SELECT url AS topic FROM pages UNION ALL SELECT source FROM documents
        UNION ALL SELECT text FROM conversations)
    WHERE length(topic) BETWEEN 1 AND 99 AND NOT contains(topic, '/') AND NOT contains(topic, '\\')
    GROUP BY topic""")
def valid_topics(spark, sf_dir):
    topics = (
        table(spark, sf_dir, "pages").select(F.col("url").alias("topic"))
        .unionAll(table(spark, sf_dir, "documents").select("source"))
        .unionAll(table(spark, sf_dir, "conversations").select("text"))
    )
    return topics.filter(values.is_valid_topic(F.col("topic"))).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@QUERIES.add("""
    SELECT event_id, TRUE AS text_set, event_id % 3 <> 0 AS fields_set, event_id % 5 <> 0 AS tag_set FROM events""")
def not_empty(spark, sf_dir):
    """Empty text is set, an empty collection is not."""
    key = F.col("event_id")
    tokens = split_fields(F.when(key % 3 == 0, "||").otherwise(F.col("event_type")), "\\|")
    tag = F.when(key % 5 != 0, F.col("event_type"))
    return events(spark, sf_dir).select(
        "event_id",
        values.is_set_and_not_empty(F.lit("")).alias("text_set"),
        values.is_set_and_not_empty(tokens, is_collection=True).alias("fields_set"),
        values.is_set_and_not_empty(tag).alias("tag_set"),
    )


@QUERIES.add("SELECT event_id, event_type AS topic FROM events")
def required_topic(spark, sf_dir):
    topic = values.require_set(F.col("topic"), "no topic")
    return event_messages(spark, sf_dir).select("event_id", topic.alias("topic"))


@QUERIES.add("""
    SELECT event_id, CASE WHEN event_id % 2 = 0 AND event_id % 3 = 0 THEN event_type ELSE 'unset' END AS chosen FROM events""")
def value_if_set(spark, sf_dir):
    key = F.col("event_id")
    first, second = F.when(key % 2 == 0, key), F.when(key % 3 == 0, key)
    chosen = values.value_if_all_set([first, second], F.col("event_type"), F.lit("unset"))
    return events(spark, sf_dir).select("event_id", chosen.alias("chosen"))


@QUERIES.add("""
    SELECT '/data/' || event_type || '-' || event_id || '.gz' AS path, event_id AS length
    FROM events WHERE event_id % 3 = 0 AND ts < TIMESTAMP '2024-01-15 11:59:30'
    UNION ALL
    SELECT '/data/' || event_type || '-' || event_id || '.parquet', event_id
    FROM events WHERE event_id % 3 = 1 AND event_id % 5 <> 0 AND ts < TIMESTAMP '2024-01-15 11:59:30'""")
def finished_files(spark, sf_dir):
    """A listing with a file per event: two finished extensions, one temporary, and
    some copies in progress; the time is 2024-01-15 12:00."""
    key = F.col("event_id")
    ending = F.when(key % 3 == 0, ".gz").when(key % 3 == 1, ".parquet").otherwise(".tmp")
    folder = F.when((key % 3 == 1) & (key % 5 == 0), "/tmp/copying").otherwise("/data/")
    path = F.concat(folder, F.col("event_type"), F.lit("-"), key.cast("string"), ending)
    listing = events(spark, sf_dir).select(path.alias("path"), F.col("ts").alias("modificationTime"), key.alias("length"))
    now = datetime(2024, 1, 15, 12, tzinfo=timezone.utc)
    return is_finished(listing, now=now).select("path", "length")
