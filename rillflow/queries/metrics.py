"""Counter, rate and statistics queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from rillflow.operators import metrics as ops
from rillflow.operators.parse import parse_messages
from rillflow.operators.quality import keyed_rows, with_hour_key
from rillflow.queries import Registry
from rillflow.queries.feeds import event_catalog, event_messages, events, parsed_events, table
from rillflow.session import work_dir
from rillflow.sinks import reports
from rillflow.sources.store import names_in

QUERIES = Registry()


@QUERIES.add("""
    SELECT event_type AS topic, strftime(ts, '%Y-%m-%d-%H') AS hour, count(*) AS messages FROM events GROUP BY 1, 2""")
def topic_hour_counts(spark, sf_dir):
    return ops.topic_hour_counts(keyed_rows(with_hour_key(parsed_events(spark, sf_dir))))


@QUERIES.add("""
    SELECT event_type AS topic, strftime(ts, '%Y-%m-%d-%H') AS hour, count(*) AS messages FROM events
    WHERE event_type IN ('click', 'purchase') GROUP BY 1, 2""")
def usable_topic_hours(spark, sf_dir):
    """Only rows with an hour count; those of unusable descriptors have none."""
    parsed = parse_messages(event_messages(spark, sf_dir), event_catalog(spark))
    return ops.topic_hour_counts(keyed_rows(with_hour_key(parsed)))


@QUERIES.add("""
    SELECT 'in' AS phase, event_type AS topic, strftime(ts, '%Y%m%d%H%M') AS minute, count(*) AS n FROM events GROUP BY 2, 3""")
def minute_counters(spark, sf_dir):
    return ops.minute_counters(parsed_events(spark, sf_dir), "in")


@QUERIES.add("""
    SELECT 'bytes' AS phase, event_type AS topic, strftime(ts, '%Y%m%d%H%M') AS minute,
           CAST(sum(length(concat_ws('|', event_id, user_id, event_type))) AS BIGINT) AS n
    FROM events WHERE event_type = 'view' GROUP BY 2, 3""")
def counters_by_topic(spark, sf_dir):
    """Counters with an increment per row, read for one phase and topic."""
    counters = ops.minute_counters(parsed_events(spark, sf_dir), "bytes", increment=F.octet_length("message"))
    return ops.counters_of(counters, "bytes", "view")


@QUERIES.add("""
    SELECT phase, topic, minute, n FROM (
        SELECT 'in' AS phase, event_type AS topic, strftime(ts, '%Y%m%d%H%M') AS minute, 2 * count(*) AS n FROM events GROUP BY 2, 3)""")
def counter_store(spark, sf_dir):
    """Two batches added up, one of them published twice and counted once."""
    path = work_dir(spark, "counters")
    counters = ops.minute_counters(parsed_events(spark, sf_dir), "in")
    for batch in ("0", "1", "1"):
        reports.publish_counters(counters, path, "run", batch)
    return reports.live_counters(spark, path)


@QUERIES.add("""
    SELECT 'in' AS phase, event_type AS topic, strftime(ts, '%Y%m%d%H%M') AS minute, count(*) AS n, CAST(4 AS BIGINT) AS folders_left FROM events GROUP BY 2, 3""")
def counter_snapshots(spark, sf_dir):
    """Fifty batches, folded three times on the way, two folded ones published again, one that came late: every increment once, few folders left."""
    path = work_dir(spark, "counters")
    rows = parsed_events(spark, sf_dir).withColumn("_batch", F.pmod(F.xxhash64("message"), F.lit(50)))
    counted = ops.minute_counters(rows, "in").limit(0)
    staged = work_dir(spark, "counted")
    rows.groupBy("_batch", "topic", ops.minute_key(F.col("ts")).alias("minute")).agg(F.count("*").alias("n")).write.partitionBy("_batch").parquet(staged)

    def publish(batch):
        mine = spark.read.parquet(staged).filter(F.col("_batch") == batch).select(F.lit("in").alias("phase"), "topic", "minute", "n")
        reports.publish_counters(mine.select(*counted.columns), path, "run", str(batch))

    for batch in range(50):
        if batch != 7:
            publish(batch)
        if batch in (19, 39):
            reports.fold_counters(spark, path)
    publish(7)
    for again in (3, 30):
        publish(again)
    reports.fold_counters(spark, path, keep=2)
    # The last fold removes what the ones before it hold; its own batches go with the next.
    reports.fold_counters(spark, path, keep=2)
    publish(40)
    publish(7)
    left = len(names_in(spark, f"{path}/run=run"))
    return reports.live_counters(spark, path).withColumn("folders_left", F.lit(left).cast("bigint"))


@QUERIES.add("""
    WITH r AS (SELECT l_returnflag, CAST(l_quantity AS BIGINT) * 10 AS ms, l_linenumber AS m FROM lineitem)
    SELECT l_returnflag, count(*) AS runs, CAST(sum(m) AS BIGINT) AS messages, CAST(round(avg(ms) * 1000) AS BIGINT) AS mean_us,
           max(ms) AS max_ms, min(ms) AS min_ms, CAST(floor(sum(m) * 1000 / avg(ms)) AS BIGINT) AS rate_per_sec
    FROM r GROUP BY 1""")
def load_stats(spark, sf_dir):
    runs = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", (F.col("l_quantity").cast("bigint") * 10).alias("elapsed_ms"), F.col("l_linenumber").alias("messages")
    )
    stats = ops.load_stats(runs, by=["l_returnflag"])
    return stats.withColumn("mean_us", F.round(F.col("mean_ms") * 1000).cast("bigint")).drop("mean_ms")


def _rate_sql(minutes: int) -> str:
    alpha = 1 - math.exp(-1 / minutes)
    return f"""round(1000000 * list_sum(list_transform(
        list(struct_pack(i := i, n := n)) OVER (PARTITION BY topic ORDER BY i RANGE BETWEEN {40 * minutes} PRECEDING AND CURRENT ROW),
        lambda x: x.n / 60.0 * exp((x.i - i) / {float(minutes)}) * CASE WHEN x.i = first THEN 1.0 ELSE {alpha!r} END)))"""


@QUERIES.add(f"""
    WITH c AS (SELECT event_type AS topic, epoch_us(ts) // 60000000 AS i, count(*) AS n FROM events GROUP BY 1, 2),
         f AS (SELECT *, min(i) OVER (PARTITION BY topic) AS first FROM c)
    SELECT topic, i AS minute_index, CAST(sum(n) OVER w AS BIGINT) AS count,
           CAST(round(1000000 * (sum(n) OVER w) / ((i - first + 1) * 60)) AS BIGINT) AS mean_rate,
           CAST({_rate_sql(1)} AS BIGINT) AS one_minute_rate, CAST({_rate_sql(5)} AS BIGINT) AS five_minute_rate
    FROM f WINDOW w AS (PARTITION BY topic ORDER BY i ROWS UNBOUNDED PRECEDING)""")
def rate_windows(spark, sf_dir):
    """Rates in messages per million seconds, as whole numbers."""
    rates = ops.message_rates(parsed_events(spark, sf_dir))
    names = ["mean_rate", *ops.RATE_WINDOWS]
    return rates.withColumns({name: F.round(F.col(name) * 1_000_000).cast("bigint") for name in names})


@QUERIES.add("""
    SELECT event_id % 4 AS partition, event_id // 4 // 1000 AS block, count(*) AS messages,
           CAST(floor(CASE WHEN max(epoch_us(ts) // 1000) > min(epoch_us(ts) // 1000)
               THEN count(*) * 1000.0 / (max(epoch_us(ts) // 1000) - min(epoch_us(ts) // 1000)) END) AS BIGINT) AS rate_per_sec
    FROM events GROUP BY 1, 2""")
def replay_rates(spark, sf_dir):
    """Blocks of 1000 messages of a replayed topic with four partitions."""
    rows = events(spark, sf_dir).select(
        F.lit("replay").alias("topic"), (F.col("event_id") % 4).alias("partition"),
        F.floor(F.col("event_id") / 4).alias("offset"), F.col("ts").alias("timestamp"),
    )
    return ops.replay_rates(rows, every=1000).drop("topic")
