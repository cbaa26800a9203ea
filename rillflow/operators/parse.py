"""Raw messages to event time, fields and message text.

Input rows carry ``topic`` and ``value`` (bytes). Output rows add

* ``ts``       event time, TIMESTAMP
* ``ts_ms``    the same in epoch milliseconds
* ``fields``   the message fields, ARRAY<STRING>
* ``message``  the message as one line, STRING
* ``format_type``  parser type
* ``error``    why the row cannot be used, or NULL

A row is never dropped here: what cannot be parsed keeps its bytes and gets an
``error``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import avro as avro_fn
from rillflow.functions.descriptors import (
    AVRO_TEXT_TYPE,
    NO_TIME_FIELD,
    TEXT_TYPE,
    descriptor_literals,
    load_descriptor,
    with_description,
)
from rillflow.functions.event_time import event_millis, millis_to_timestamp
from rillflow.functions.text import decode_text, field_at, field_range, join_fields, split_fields
from rillflow.operators.catalog import codec_for, output_format_or_default
from rillflow.operators.lookup import lookup_join

# Settings of the parser, as columns of the row (joined from the catalog) or as
# constants.
Settings = Mapping[str, Column]

_SETTING_NAMES = ("type", "separator", "split_on", "ts_index", "ts_scale", "msg_index", "msg_start", "msg_end", "problem")
_PREFIX = "_d_"


def _flat(described: Column) -> list[Column]:
    return [described[name].alias(_PREFIX + name) for name in _SETTING_NAMES]


def _row_settings() -> Settings:
    return {name: F.col(_PREFIX + name) for name in _SETTING_NAMES}


def _parse_text(df: DataFrame, d: Settings) -> DataFrame:
    """Adds ``_count`` (all fields), ``_fields`` (message fields) and ``_ms``.

    Each step is a column of its own, so the generated code computes it once and
    stays small enough for the JVM to compile.
    """
    usable = (d["type"] == TEXT_TYPE) & d["problem"].isNull()
    df = df.withColumn("_all", F.when(usable, split_fields(decode_text(F.col("value")), d["split_on"])))
    df = df.withColumns({
        "_count": F.size("_all"),
        "_time": F.when(d["ts_index"] >= 0, F.get("_all", d["ts_index"])),
        "_fields": F.when(d["msg_index"].isNotNull(), field_at(F.col("_all"), d["msg_index"]))
        .otherwise(field_range(F.col("_all"), d["msg_start"], d["msg_end"])),
    })
    return df.withColumn("_ms", F.when(usable, event_millis(F.col("_time"), d["ts_index"], d["ts_scale"])))


def _text_error(d: Settings) -> Column:
    return (
        F.when(d["problem"].isNotNull(), d["problem"])
        .when(d["type"].isNull(), F.lit(NO_TIME_FIELD))
        .when(F.col("value").isNull(), F.lit("message has no value"))
        .when(d["ts_index"] >= F.col("_count"), F.lit("time field is past the last field"))
        .when(F.col("_ts").isNull(), F.lit("time field is not a time"))
        .when(d["msg_index"] >= F.col("_count"), F.lit("message field is past the last field"))
    )


def _parse_avro(df: DataFrame, d: Settings, schemas: Mapping[str, str], indexes: Mapping[str, tuple]) -> DataFrame:
    is_avro = d["type"] == AVRO_TEXT_TYPE
    decoded = avro_fn.decode_columns(df, schemas, indexes)
    df = df.withColumn("_avro", F.when(is_avro & d["problem"].isNull(), decoded))
    message = F.col("_avro")["message"]
    return df.withColumns({
        "_ms": F.when(is_avro, F.try_multiply(F.col("_avro")["ts_ms"], d["ts_scale"].cast("bigint"))).otherwise(F.col("_ms")),
        "_fields": F.when(is_avro, F.when(message.isNotNull(), F.array(message))).otherwise(F.col("_fields")),
    })


def _avro_error(schemas: Mapping[str, str]) -> Column:
    missing = F.lit("no Avro schema given for the topic")
    if not schemas:
        return missing
    failed = F.when(F.col("_fields").isNull() | F.col("_ts").isNull(), F.lit("record cannot be decoded"))
    return F.when(F.col("topic").isin(list(schemas)), failed).otherwise(missing)


def _parse(df: DataFrame, d: Settings, avro_schemas: Mapping[str, str], avro_indexes: Mapping[str, tuple]) -> DataFrame:
    keep = [c for c in df.columns if not c.startswith(_PREFIX)]
    df = _parse_text(df, d)
    if avro_schemas:
        df = _parse_avro(df, d, avro_schemas, avro_indexes)
    df = df.withColumn("_ts", millis_to_timestamp(F.col("_ms")))
    is_avro = (d["type"] == AVRO_TEXT_TYPE) & d["problem"].isNull()
    df = df.withColumn("_error", F.when(is_avro, _avro_error(avro_schemas)).otherwise(_text_error(d)))
    ok = F.col("_error").isNull()
    df = computed_once(df, {
        "error": F.col("_error"),
        "ts": F.when(ok, F.col("_ts")),
        "ts_ms": F.when(ok, F.col("_ms")),
        "fields": F.when(ok, F.col("_fields")),
    })
    message = join_fields(F.col("fields"), d["separator"])
    return df.select(*keep, "ts", "ts_ms", "fields", message.alias("message"), d["type"].alias("format_type"), "error")


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Adds columns that later filters and projections refer to without repeating
    them.

    Catalyst moves a filter on a plain column below its projection and puts the
    whole expression into the filter. For parsed rows that repeats the parsing
    in every filter and makes generated methods too large for the JVM to
    compile. A filter on the output of a generator stays above it.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def parse_messages(
    messages: DataFrame,
    catalog: DataFrame,
    avro_schemas: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parse every message with the descriptor of its topic, and add its ``codec``.

    The catalog is described before the join, so per message only the parsing
    itself runs. A topic without a catalog row has no usable descriptor.
    ``avro_schemas`` maps topic to record schema (JSON) for ``avro-txt`` topics.
    """
    described = with_description(catalog.select("log", "format", "output_format"), F.col("format"), "_described").select(
        "log",
        codec_for(output_format_or_default(F.col("output_format"))).alias("_codec"),
        *_flat(F.col("_described")),
    )
    indexes = {}
    if avro_schemas:
        rows = described.filter(F.col("log").isin(list(avro_schemas)))
        for row in rows.select("log", "_d_ts_index", "_d_msg_index").toLocalIterator():
            indexes[row["log"]] = (row["_d_ts_index"], row["_d_msg_index"])
    joined = lookup_join(messages, described, "topic", "log")
    unknown_codec = codec_for(output_format_or_default(F.lit(None).cast("string")))
    joined = joined.withColumn("codec", F.coalesce(F.col("_codec"), unknown_codec)).drop("_codec")
    return _parse(joined, _row_settings(), avro_schemas or {}, indexes)


def parse_with_descriptor(messages: DataFrame, descriptor: str) -> DataFrame:
    """Parse every text message with one descriptor; its settings become literals."""
    literal = descriptor_literals(load_descriptor(messages.sparkSession, descriptor))
    return _parse(messages, literal, {}, {})


def parse_with_column(messages: DataFrame, descriptor: Column) -> DataFrame:
    """Parse each text message with a descriptor carried on the row itself."""
    df = with_description(messages, descriptor, "_described")
    return _parse(df.select(*messages.columns, *_flat(F.col("_described"))), _row_settings(), {}, {})
