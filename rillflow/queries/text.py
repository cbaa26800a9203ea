"""Parsing queries: descriptors, fields, ranges, event time, Avro and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillflow.functions import avro, json_text, text
from rillflow.functions.descriptors import descriptor_type, typed_value, with_props
from rillflow.operators.catalog import make_catalog
from rillflow.operators.parse import parse_messages, parse_with_column, parse_with_descriptor
from rillflow.queries import Registry
from rillflow.queries.feeds import (
    EVENT_LINE_SQL,
    bytes_of,
    event_catalog,
    event_messages,
    events,
    pick,
    table,
)
from rillflow.sources.generator import RECORD_SCHEMA

QUERIES = Registry()

_GAPPY = "event_id || '|' || CASE WHEN event_id % 3 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END || '|' || event_type || '||' || (epoch_us(ts) // 1000)"


@QUERIES.add(f"""
    WITH f AS (SELECT event_id, list_filter(string_split({_GAPPY}, '|'), lambda x: x <> '') AS fields FROM events)
    SELECT event_id, len(fields) AS n_fields, fields[1] AS f0, fields[2] AS f1, fields[3] AS f2, fields[4] AS f3 FROM f""")
def txt_fields(spark, sf_dir):
    gappy = F.concat(
        F.col("event_id").cast("string"), F.lit("|"),
        F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("user_id").cast("string")),
        F.lit("|"), "event_type", F.lit("||"), F.col("ms").cast("string"),
    )
    df = events(spark, sf_dir).select("event_id", text.split_fields(text.decode_text(bytes_of(gappy)), "\\|").alias("fields"))
    return df.select(
        "event_id", F.size("fields").cast("bigint").alias("n_fields"),
        *[F.get("fields", F.lit(i)).alias(f"f{i}") for i in range(4)],
    )


@QUERIES.add("SELECT event_id, event_type AS message, epoch_us(ts) // 1000 AS ts_ms, CAST(NULL AS VARCHAR) AS error FROM events")
def txt_index(spark, sf_dir):
    parsed = parse_with_descriptor(event_messages(spark, sf_dir), "txt:sep=pipe;ts=3;msg=2")
    return parsed.select("event_id", "message", "ts_ms", "error")


_RANGES = ("-1:-1", "2:-1", "2:4", "2:2", "2:1", "1:640", "7000:900", ":2", "1:", "-1", "3", "0:", ":-7")


@QUERIES.add(f"""
    WITH f AS (SELECT event_id, event_id % 13 AS r, string_split({EVENT_LINE_SQL}, '|') AS a FROM events),
         s AS (SELECT event_id, CASE
             WHEN r IN (0, 9, 11, 12) THEN a
             WHEN r = 1 THEN a[3:4] WHEN r = 2 THEN a[3:4] WHEN r = 3 THEN a[3:3] WHEN r = 4 THEN a[3:3]
             WHEN r = 5 THEN a[2:4] WHEN r = 6 THEN [] WHEN r = 7 THEN a[1:2] WHEN r = 8 THEN a[2:4]
             WHEN r = 10 THEN a[4:4] END AS a FROM f)
    SELECT event_id, len(a) AS n_fields, array_to_string(a, '|') AS message FROM s""")
def txt_range(spark, sf_dir):
    descriptor = F.concat(F.lit("txt:sep=pipe;msg="), pick(F.col("event_id"), *_RANGES), F.lit(";ts=3"))
    parsed = parse_with_column(event_messages(spark, sf_dir), descriptor)
    return parsed.select("event_id", F.size("fields").cast("bigint").alias("n_fields"), "message")


@QUERIES.add("""
    WITH f AS (SELECT doc_id, list_filter(string_split(text, ' '), lambda x: x <> '') AS a FROM documents)
    SELECT doc_id, len(a) AS n_fields, md5(array_to_string(a, ' ')) AS message_md5,
           octet_length(encode(array_to_string(a, ' '))) AS n_bytes FROM f""")
def txt_rejoin(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("topic"), bytes_of(F.col("text")).alias("value"))
    parsed = parse_with_descriptor(docs, "txt:sep=space;msg=0:;ts=-1")
    return parsed.select(
        "doc_id",
        F.size("fields").cast("bigint").alias("n_fields"),
        F.md5(text.encode_text(F.col("message"))).alias("message_md5"),
        F.octet_length("message").cast("bigint").alias("n_bytes"),
    )


@QUERIES.add("SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, strftime(ts, '%Y-%m-%d %H:%M') AS minute FROM events")
def ts_millis(spark, sf_dir):
    parsed = parse_with_descriptor(event_messages(spark, sf_dir), "txt:sep=pipe;ts_ms=3")
    return parsed.select("event_id", "ts_ms", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"))


@QUERIES.add("SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS ts_ms FROM orders")
def ts_seconds(spark, sf_dir):
    from rillflow.queries.feeds import order_messages

    parsed = parse_with_descriptor(order_messages(spark, sf_dir), "txt:sep=pipe;ts_sec=2;msg=0")
    return parsed.select("o_orderkey", "ts_ms")


@QUERIES.add("SELECT event_id, TRUE AS is_now FROM events")
def ts_now(spark, sf_dir):
    parsed = parse_with_descriptor(event_messages(spark, sf_dir), "txt:sep=pipe;ts=-1")
    return parsed.select("event_id", (F.col("ts") == F.timestamp_millis(F.unix_millis(F.current_timestamp()))).alias("is_now"))


@QUERIES.add("""
    SELECT event_id, CASE event_id % 5
        WHEN 0 THEN epoch_us(ts) // 1000
        WHEN 1 THEN epoch_ms(date_trunc('second', ts))
        WHEN 2 THEN epoch_ms(date_trunc('day', ts))
        WHEN 3 THEN epoch_ms(date_trunc('second', ts))
        WHEN 4 THEN epoch_ms(date_trunc('day', ts)) END AS ts_ms
    FROM events""")
def ts_iso(spark, sf_dir):
    """Five ISO shapes of the same times, told apart per row."""
    ts = F.col("ts")
    shapes = ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyyMMdd'T'HHmmss'Z'", "yyyy-DDD")
    shown = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, shape in enumerate(shapes):
        shown = shown.when(F.col("event_id") % len(shapes) == i, F.date_format(ts, shape))
    line = F.concat_ws("\t", "event_id", shown)
    df = events(spark, sf_dir).select("event_id", F.col("event_type").alias("topic"), bytes_of(line).alias("value"))
    return parse_with_descriptor(df, "txt:sep=tab;ts=1").select("event_id", "ts_ms")


_DESCRIPTORS = ("txt:sep=pipe;msg=1:-1;ts=", "avro-txt:flag=true;msg=1;ts=", "txt:ts=9;tail=false;ts=", "csv:ts_sec=")


@QUERIES.add(f"""
    WITH d AS (SELECT event_id, event_id % 4 AS k, user_id FROM events)
    SELECT event_id,
           CASE k WHEN 1 THEN 'avro-txt' WHEN 3 THEN 'csv' ELSE 'txt' END AS type,
           CASE WHEN k = 0 THEN 'pipe' END AS sep,
           CASE k WHEN 0 THEN '1:-1' WHEN 1 THEN '1' END AS msg,
           CASE WHEN k <> 3 THEN user_id END AS ts,
           CASE WHEN k = 3 THEN user_id END AS ts_sec,
           CASE WHEN k = 1 THEN TRUE END AS flag,
           CASE WHEN k = 2 THEN FALSE END AS tail,
           CASE k WHEN 0 THEN 3 WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 1 END AS n_props
    FROM d""")
def descriptor_props(spark, sf_dir):
    descriptor = F.concat(pick(F.col("event_id"), *_DESCRIPTORS), F.col("user_id").cast("string"))
    df = events(spark, sf_dir).select("event_id", descriptor.alias("d"))
    df = with_props(df, F.col("d"))
    props = F.col("props")
    return df.select(
        "event_id",
        descriptor_type(F.col("d")).alias("type"),
        typed_value(props["sep"])["string_value"].alias("sep"),
        props["msg"].alias("msg"),
        typed_value(props["ts"])["long_value"].alias("ts"),
        typed_value(props["ts_sec"])["long_value"].alias("ts_sec"),
        typed_value(props["flag"])["bool_value"].alias("flag"),
        typed_value(props["tail"])["bool_value"].alias("tail"),
        F.size("props").alias("n_props"),
    )


_SEPARATORS = (("byte1", "\u0001"), ("tab", "\t"), ("space", " "), ("semicolon", ";"), ("pipe", "|"), ("comma", ","), ("#", "#"), (None, "\u0001"))


@QUERIES.add("SELECT event_id, user_id, event_type AS message, epoch_us(ts) // 1000 AS ts_ms FROM events")
def separators(spark, sf_dir):
    """Each row uses another separator, by word, by character or by default."""
    key = F.col("event_id")
    char = pick(key, *[c for _, c in _SEPARATORS])
    word = pick(key, *[w for w, _ in _SEPARATORS])
    line = F.concat(key.cast("string"), char, F.col("ms").cast("string"), char, char, "event_type")
    df = events(spark, sf_dir).select("event_id", "user_id", F.col("event_type").alias("topic"), bytes_of(line).alias("value"), word.alias("sep"))
    setting = F.when(F.col("sep").isNotNull(), F.concat(F.lit("sep="), "sep", F.lit(";"))).otherwise("")
    parsed = parse_with_column(df, F.concat(F.lit("txt:"), setting, F.lit("ts=1;msg=2")))
    return parsed.select("event_id", "user_id", "message", "ts_ms")


@QUERIES.add(f"""
    SELECT event_id, event_type AS topic,
           CASE event_type WHEN 'view' THEN 'json' WHEN 'signup' THEN NULL ELSE 'txt' END AS format_type,
           CASE WHEN event_type IN ('click', 'purchase') THEN epoch_us(ts) // 1000 END AS ts_ms,
           CASE event_type WHEN 'click' THEN concat_ws('|', event_id, user_id, event_type)
                           WHEN 'purchase' THEN CAST(user_id AS VARCHAR) END AS message,
           CASE event_type WHEN 'click' THEN 'parquet' WHEN 'purchase' THEN 'snappy' ELSE 'none' END AS codec,
           CASE event_type WHEN 'error' THEN 'time field is not a time'
                           WHEN 'view' THEN 'no parser for format type json'
                           WHEN 'signup' THEN 'format names no ts, ts_ms or ts_sec field' END AS error
    FROM events""")
def multi_format_parse(spark, sf_dir):
    """One plan for every descriptor of a catalog, with each kind of failure kept."""
    parsed = parse_messages(event_messages(spark, sf_dir), event_catalog(spark))
    return parsed.select("event_id", "topic", "format_type", "ts_ms", "message", "codec", "error")


def _records(spark, sf_dir):
    """Events as records of a time and a text, the shape of a decoded Avro message."""
    record = F.struct(F.col("ms").alias("ts"), F.concat_ws(" ", "event_type", "props").alias("data"))
    return events(spark, sf_dir).select("event_id", record.alias("record"))


@QUERIES.add("""
    SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, event_type || ' ' || props AS message, CAST(NULL AS VARCHAR) AS past FROM events""")
def record_picks(spark, sf_dir):
    """Time and message of records picked by position; a position past the last field has nothing."""
    rows = _records(spark, sf_dir)
    schema, record = rows.schema["record"].dataType, F.col("record")
    return rows.select(
        "event_id", avro.record_millis(record, schema, 0).alias("ts_ms"), avro.record_text(record, schema, 1).alias("message"),
        avro.record_text(record, schema, 2).alias("past"),
    )


@QUERIES.add("""
    SELECT event_id, '{"ts":' || (epoch_us(ts) // 1000) || ',"data":"' || event_type || '"}' AS message FROM events""")
def record_whole_text(spark, sf_dir):
    """A whole record as JSON text."""
    rows = events(spark, sf_dir).select("event_id", F.struct(F.col("ms").alias("ts"), F.col("event_type").alias("data")).alias("record"))
    return rows.select("event_id", F.decode(avro.text_bytes(F.col("record"), rows.schema["record"].dataType, -1), "UTF-8").alias("message"))


@QUERIES.add("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           '{"id":' || event_id || ',"type":"' || event_type || '"}' AS json FROM events""")
def json_props(spark, sf_dir):
    df = events(spark, sf_dir)
    encoded = json_text.to_json_bytes(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type")))
    decoded = json_text.from_json_bytes(encoded, "id bigint, type string")
    return df.select(
        "event_id",
        json_text.from_json_text(F.col("props"), "k bigint")["k"].alias("k"),
        F.to_json(decoded).alias("json"),
    )
