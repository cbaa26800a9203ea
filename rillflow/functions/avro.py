"""Avro-wrapped text: framed records, the time and message fields picked by position.

A framed value is one zero byte, a four-byte schema id and the record. Records
are decoded and encoded by Spark's Avro package; everything after that works on
the struct.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, StructType

from rillflow.functions.event_time import now_millis

# Bytes before the record in a framed value.
HEADER_BYTES = 5
MAGIC_BYTE = 0

def has_avro_package(spark: SparkSession) -> bool:
    loader = spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    try:
        loader.loadClass("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:
        return False
    return True


def _require(spark: SparkSession) -> None:
    if not has_avro_package(spark):
        raise RuntimeError("start the session with the spark-avro package")


def strip_header(value: Column) -> Column:
    """The record inside a framed value; NULL when the frame is malformed."""
    framed = (F.octet_length(value) > HEADER_BYTES) & (F.substring(value, 1, 1) == F.lit(bytes([MAGIC_BYTE])))
    return F.when(framed, F.substring(value, HEADER_BYTES + 1, 2**31 - 1 - HEADER_BYTES))


def add_header(record: Column, schema_id: int) -> Column:
    header = bytes([MAGIC_BYTE]) + schema_id.to_bytes(4, "big")
    return F.concat(F.lit(header), record)


def decode_record(spark: SparkSession, record: Column, schema_json: str) -> Column:
    """Record bytes to a struct; malformed bytes give NULL. Needs Spark's Avro package."""
    _require(spark)
    from pyspark.sql.avro.functions import from_avro

    return from_avro(record, schema_json, {"mode": "PERMISSIVE"})


def encode_record(spark: SparkSession, record: Column, schema_json: str) -> Column:
    """A struct to record bytes. Needs Spark's Avro package."""
    _require(spark)
    from pyspark.sql.avro.functions import to_avro

    return to_avro(record, schema_json)


def frame(spark: SparkSession, record: Column, schema_json: str, schema_id: int) -> Column:
    return add_header(encode_record(spark, record, schema_json), schema_id)


def unframe(spark: SparkSession, value: Column, schema_json: str) -> Column:
    return decode_record(spark, strip_header(value), schema_json)


def record_field(record: Column, schema: StructType, index: int) -> Column:
    """Field of a record by position, under whatever name the schema gives it."""
    return record[schema.fields[index].name] if 0 <= index < len(schema.fields) else F.lit(None)


def record_millis(record: Column, schema: StructType, index: int) -> Column:
    """Event time of a record: processing time for a negative index, the number of
    a numeric field, and processing time for any field that is neither a number
    nor a date."""
    if index < 0:
        return now_millis()
    if index >= len(schema.fields):
        return F.lit(None).cast("bigint")
    field = schema.fields[index]
    value = record[field.name]
    if isinstance(field.dataType, (LongType, IntegerType, FloatType, DoubleType)):
        return F.when(value.isNotNull(), value.try_cast("bigint")).otherwise(now_millis())
    if field.dataType.typeName() in ("timestamp", "date"):
        return F.unix_millis(value.cast("timestamp"))
    return now_millis()


def record_text(record: Column, schema: StructType, index: int) -> Column:
    """Message text: one field, or the whole record as JSON for index -1."""
    if index < 0:
        return F.to_json(record)
    return record_field(record, schema, index).cast("string")


def text_bytes(record: Column, schema: StructType, index: int) -> Column:
    return F.encode(record_text(record, schema, index), "UTF-8")


def decode_columns(df: DataFrame, schemas: Mapping[str, str], settings: Mapping[str, tuple]) -> Column:
    """``struct<ts_ms, message>`` of framed values, by topic.

    Topics that share a schema and settings share one decoder.
    """
    spark = df.sparkSession
    groups: dict[tuple, list[str]] = {}
    for topic, schema_json in schemas.items():
        if topic in settings and None not in settings[topic]:
            groups.setdefault((schema_json, *settings[topic]), []).append(topic)
    result = F.when(F.lit(False), F.struct(F.lit(None).cast("bigint").alias("ts_ms"), F.lit(None).cast("string").alias("message")))
    for (schema_json, ts_index, msg_index), topics in groups.items():
        mine = F.col("topic").isin(topics)
        record = unframe(spark, F.when(mine, F.col("value")), schema_json)
        schema = df.select(record.alias("record")).schema["record"].dataType
        picked = F.struct(
            record_millis(record, schema, ts_index).alias("ts_ms"),
            record_text(record, schema, msg_index).alias("message"),
        )
        result = result.when(mine & record.isNotNull(), picked)
    return result
