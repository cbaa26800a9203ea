"""Streaming queries, each run to the end of its input and read back."""

from __future__ import annotations

import threading
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from rillflow.operators import metrics
from rillflow.operators.catalog import PublishDefaults, load_catalog, make_catalog, save_catalog
from rillflow.operators.parse import parse_with_descriptor
from rillflow.plans.ingest import IngestPlan
from rillflow.plans.pipelines import ColumnPlugin
from rillflow.queries import Registry
from rillflow.queries.feeds import event_catalog, event_lines, event_messages, landing_catalog, parsed_events, table
from rillflow.queries.landing import _LANDED_SQL, _LINE, _land_all, _publish_catalog, _published, _PUBLISHED_SQL
from rillflow.queries.metrics import _rate_sql
from rillflow.session import work_dir
from rillflow.sinks import landing, reports
from rillflow.sources.files import stream_messages
from rillflow.streaming import ingest, publish, topics

QUERIES = Registry()


def _stream(spark, sf_dir):
    """Event lines as a stream of raw messages."""
    schema = table(spark, sf_dir, "events").schema
    return event_lines(stream_messages(spark, f"{sf_dir}/events.parquet*", schema)).drop("event_id")


@QUERIES.add(_LANDED_SQL)
def stream_text_landing(spark, sf_dir):
    """The file sink: one commit per micro-batch."""
    root = work_dir(spark, "stream")
    parsed = parse_with_descriptor(_stream(spark, sf_dir), "txt:sep=pipe;msg=0:3;ts=3")
    query = ingest.start_text_landing(parsed, f"{root}/out", f"{root}/checkpoint", available_now=True)
    query.awaitTermination()
    return spark.read.text(f"{root}/out").select("topic", F.col("hour").cast("string").alias("hour"), F.col("value").alias("line"))


def _run_ingest(spark, sf_dir, catalog, available_now=True):
    root = work_dir(spark, "ingest")
    plan = ingest.StreamPlan(
        IngestPlan(f"{root}/landing", writers=1), lambda: catalog, f"{root}/checkpoint",
        quarantine=f"{root}/quarantine", counters=f"{root}/counters",
    )
    query = ingest.start_ingest(_stream(spark, sf_dir), plan, available_now=available_now)
    if available_now:
        query.awaitTermination()
    else:
        ingest.drain(query)
    return root, plan


@QUERIES.add(f"""
    SELECT event_type AS topic, strftime(ts, '%Y-%m-%d-%H') AS hour, {_LINE} AS line FROM events WHERE event_type <> 'view'
    UNION ALL
    SELECT event_type, strftime(ts, '%Y-%m-%d-%H'), {_LINE} FROM events WHERE event_type = 'view'""")
def stream_ingest(spark, sf_dir):
    """The whole ingest plan as a stream, drained and stopped."""
    root, _ = _run_ingest(spark, sf_dir, landing_catalog(spark), available_now=False)
    text = landing.landed_text(spark, f"{root}/landing").select("topic", "hour", F.col("value").alias("line"))
    columnar = spark.read.parquet(f"{root}/landing/parquet")
    line = F.array_join("fields", "|").alias("line")
    return text.unionByName(columnar.select("topic", F.col("hour").cast("string").alias("hour"), line))


@QUERIES.add("""
    SELECT event_type AS topic, count(*) AS n,
           CASE event_type WHEN 'error' THEN 'time field is not a time' WHEN 'view' THEN 'no parser for format type json'
                ELSE 'format names no ts, ts_ms or ts_sec field' END AS error
    FROM events WHERE event_type NOT IN ('click', 'purchase') GROUP BY 1, 3""")
def stream_quarantine(spark, sf_dir):
    root, _ = _run_ingest(spark, sf_dir, event_catalog(spark))
    return spark.read.parquet(f"{root}/quarantine").groupBy("topic", "error").agg(F.count(F.lit(1)).alias("n"))


@QUERIES.add("""
    SELECT CASE WHEN event_type IN ('click', 'purchase') THEN 'in' ELSE 'error' END AS phase, event_type AS topic, count(*) AS n
    FROM events GROUP BY 1, 2""")
def stream_counters(spark, sf_dir):
    """Counters of good and bad rows. A batch run again is counted once."""
    root, plan = _run_ingest(spark, sf_dir, event_catalog(spark))
    batch = event_messages(spark, sf_dir).drop("event_id")
    ingest.IngestStream(plan)(batch, 0)
    live = reports.live_counters(spark, f"{root}/counters")
    return live.groupBy("phase", "topic").agg(F.sum("n").alias("n"))


@QUERIES.add("""
    SELECT 'in' AS phase, event_type AS topic, strftime(ts, '%Y%m%d%H%M') AS minute, count(*) AS n FROM events GROUP BY 2, 3""")
def stream_windows(spark, sf_dir):
    """Minute windows with a watermark, in update mode: a batch gives the windows it
    changed and the watermark frees the state of old ones. The last update of a window counts."""
    root = work_dir(spark, "windows")
    parsed = parse_with_descriptor(_stream(spark, sf_dir), "txt:sep=pipe;msg=0:3;ts=3")
    counted = metrics.windowed_counters(parsed.filter(F.col("error").isNull()), "in")
    query = (
        counted.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}"))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    updates = spark.read.parquet(f"{root}/out")
    return updates.groupBy("phase", "topic", "minute").agg(F.max_by("n", "batch").alias("n"))


@QUERIES.add("""
    SELECT event_type AS topic, count(*) AS landed, count(*) AS counted FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1""")
def stream_two_topics(spark, sf_dir):
    """Two queries, one landing folder and one counter table: all rows and counts of both are there."""
    root = work_dir(spark, "two")
    for topic in ("click", "purchase"):
        plan = ingest.StreamPlan(IngestPlan(f"{root}/landing", writers=1), lambda: event_catalog(spark), f"{root}/checkpoint-{topic}", counters=f"{root}/counters")
        source = _stream(spark, sf_dir).filter(F.col("topic") == topic)
        # The topics' codecs differ; here all land as text.
        plan.ingest.definition = {"plugins": {"text": ColumnPlugin(lambda columns: {"codec": F.lit("gzip")})}, "pipeline": ["->", "text", "disk-writer"]}
        ingest.start_ingest(source, plan, available_now=True).awaitTermination()
    landed = landing.landed_text(spark, f"{root}/landing").groupBy("topic").agg(F.count("*").alias("landed"))
    counted = reports.live_counters(spark, f"{root}/counters").groupBy("topic").agg(F.sum("n").alias("counted"))
    return landed.join(counted, "topic")


#: Seconds within which topics must start or stop when the catalog says so.
_TOPICS_FOLLOW = 600


def _wait_until(reached, loop) -> None:
    """Until ``reached()``; a loop that has ended raises what ended it."""
    deadline = time.monotonic() + _TOPICS_FOLLOW
    while not reached():
        if loop.done():
            loop.result()
            raise RuntimeError("the topic loop has ended")
        if time.monotonic() > deadline:
            raise TimeoutError("the topics did not follow the catalog")
        time.sleep(0.05)


@QUERIES.add("""
    WITH e AS (SELECT *, event_id % 3 AS part, event_type || '|' || epoch_us(ts) // 1000 AS tail FROM events),
         l AS (SELECT event_type AS topic, strftime(ts, '%Y-%m-%d-%H') AS hour,
                      CASE WHEN event_type = 'view' OR (event_type = 'click' AND part = 0) THEN event_id || '|' || user_id || '|' || event_type
                           WHEN event_type = 'click' THEN event_id || '|' || user_id ELSE CAST(user_id AS VARCHAR) END AS line
               FROM e WHERE event_type IN ('click', 'purchase', 'view'))
    SELECT topic, count(*) AS n, count(DISTINCT hour) AS hours, sha256(string_agg(hour || ' ' || line, chr(10) ORDER BY hour, line)) AS lines_sha256,
           topic || ':' || CASE topic WHEN 'view' THEN '2' ELSE '1' END AS starts
    FROM l GROUP BY 1""")
def stream_followed_topics(spark, sf_dir):
    """The topic loop with a stream for each topic: one is disabled in the stored catalog while a part of the input
    arrives and enabled again before the next, and continues at its checkpoint; another gets a new format, which its
    running stream takes at its next micro-batch. Every row is landed once."""
    root = work_dir(spark, "followed")
    source = table(spark, sf_dir, "events")
    formats = {"click": "txt:sep=pipe;ts=3;msg=0:3", "purchase": "txt:sep=pipe;ts=3;msg=1", "view": "txt:sep=pipe;ts=3;msg=0:3"}

    def save(snapshot: int, view: int, **changed: str) -> None:
        rows = [{"log": t, "format": f, "output_format": "parquet", "log_group": "etl", "enabled": view if t == "view" else 1} for t, f in (formats | changed).items()]
        # Of another group: never started.
        rows.append({"log": "signup", "format": "txt:sep=pipe;ts=3;msg=1", "log_group": "web"})
        save_catalog(make_catalog(spark, rows), f"{root}/catalog", snapshot)

    def add_part(part: int) -> None:
        source.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/in")

    running, started = {}, []

    def start(topic: str):
        plan = ingest.StreamPlan(IngestPlan(f"{root}/landing", writers=1), lambda: load_catalog(spark, f"{root}/catalog"), f"{root}/checkpoint-{topic}")
        lines = event_lines(stream_messages(spark, f"{root}/in", source.schema)).drop("event_id").filter(F.col("topic") == topic)
        started.append(topic)
        running[topic] = ingest.start_ingest(lines, plan, interval_ms=100)
        return running[topic]

    def active() -> set[str]:
        return {topic for topic, query in list(running.items()) if query.isActive}

    def drain(loop, *topics_on: str) -> None:
        _wait_until(lambda: active() == set(topics_on), loop)
        for topic in topics_on:
            running[topic].processAllAvailable()

    everyone, stopped = ("click", "purchase", "view"), threading.Event()
    save(0, view=1)
    add_part(0)
    with ThreadPoolExecutor(1) as pool:
        follow = inheritable_thread_target(spark)(topics.follow_catalog)
        loop = pool.submit(follow, lambda: load_catalog(spark, f"{root}/catalog"), "etl", start, stopped, 100)
        try:
            drain(loop, *everyone)
            save(1, view=0, click="txt:sep=pipe;ts=3;msg=0:2")
            _wait_until(lambda: active() == {"click", "purchase"}, loop)
            add_part(1)
            drain(loop, "click", "purchase")
            save(2, view=1, click="txt:sep=pipe;ts=3;msg=0:2")
            add_part(2)
            drain(loop, *everyone)
        finally:
            stopped.set()
        loop.result()
    landed = spark.read.parquet(f"{root}/landing/parquet").select("topic", F.col("hour").cast("string").alias("hour"), F.array_join("fields", "|").alias("line"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("hour", "line"))), lambda x: F.concat_ws(" ", x["hour"], x["line"]))
    counted = landed.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("hour").alias("hours"), F.sha2(F.array_join(lines, "\n"), 256).alias("lines_sha256")
    )
    times = spark.createDataFrame([(t, f"{t}:{started.count(t)}") for t in sorted(set(started))], "topic string, starts string")
    return counted.join(times, "topic")


@QUERIES.add(_PUBLISHED_SQL)
def stream_publish(spark, sf_dir):
    """Landed batches published as they are found."""
    path = _land_all(spark, sf_dir, "landing")
    root = work_dir(spark, "lake")
    catalog = _publish_catalog(spark, root, "unused")
    query = publish.start_publish(
        spark, path, lambda: catalog, f"{path}-checkpoint", PublishDefaults(base_partition=f"{root}/default"), available_now=True, register=False,
    )
    query.awaitTermination()
    return _published(spark, root)


@QUERIES.add(f"""
    WITH c AS (SELECT event_type AS topic, epoch_us(ts) // 60000000 AS i, count(*) AS n FROM events GROUP BY 1, 2),
         f AS (SELECT *, min(i) OVER (PARTITION BY topic) AS first FROM c),
         r AS (SELECT topic, i AS minute_index, CAST(sum(n) OVER w AS BIGINT) AS count,
                      CAST(round(1000000 * (sum(n) OVER w) / ((i - first + 1) * 60)) AS BIGINT) AS mean_rate,
                      CAST({_rate_sql(1)} AS BIGINT) AS one_minute_rate, CAST({_rate_sql(5)} AS BIGINT) AS five_minute_rate
               FROM f WINDOW w AS (PARTITION BY topic ORDER BY i ROWS UNBOUNDED PRECEDING))
    SELECT * FROM r WHERE (minute_index + 1) * 60000 <= (SELECT max(epoch_us(ts)) // 1000 - 60000 FROM events)""")
def stream_rates(spark, sf_dir):
    """The meter as a stream that is stopped and started again twice, each time with the next ten days: the values of all closed minutes."""
    root = work_dir(spark, "meter")
    rows = parsed_events(spark, sf_dir).select("topic", "ts")
    ends = rows.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(F.unix_seconds("a").alias("a"), F.unix_seconds("b").alias("b")).first()
    third = F.least(F.floor((F.unix_seconds("ts") - ends["a"]) * 3 / (ends["b"] - ends["a"] + 1)), F.lit(2))
    for part in range(3):
        rows.filter(third == part).write.mode("append").parquet(f"{root}/in")
        rates = metrics.streamed_rates(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), watermark="1 minute")
        spark.conf.set(*metrics.STATE_STORE)
        query = (
            rates.writeStream.outputMode("append").format("parquet")
            .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        spark.conf.unset(metrics.STATE_STORE[0])
    names = ["mean_rate", *metrics.RATE_WINDOWS]
    return spark.read.parquet(f"{root}/out").withColumns({name: F.round(F.col(name) * 1_000_000).cast("bigint") for name in names})
