"""Format descriptors: ``type:key=value;key=value``, one per topic in the catalog.

A descriptor is read with column expressions, so a whole catalog is described in
one projection and the parser picks its settings up from the joined row. The
plan keeps the same size however many descriptors the catalog holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rillflow.functions.event_time import is_digits
from rillflow.functions.text import split_pattern

# The names a descriptor may use for its separator.
SEPARATOR_WORDS = {
    "byte1": "\u0001",
    "tab": "\t",
    "space": " ",
    "semicolon": ";",
    "pipe": "|",
    "comma": ",",
}
DEFAULT_SEPARATOR = "\u0001"

# Parser types, the type assumed without a descriptor, and the
# field range returned without a msg setting.
TEXT_TYPE = "txt"
AVRO_TEXT_TYPE = "avro-txt"
DEFAULT_DESCRIPTOR = "txt"
DEFAULT_RANGE = "0:"

NO_TIME_FIELD = "format names no ts, ts_ms or ts_sec field"


def _clean(descriptor: Column) -> Column:
    return F.regexp_replace(F.coalesce(descriptor, F.lit(DEFAULT_DESCRIPTOR)), r":+\z", "")


def descriptor_type(descriptor: Column) -> Column:
    return F.substring_index(_clean(descriptor), ":", 1)


def with_props(df: DataFrame, descriptor: Column, name: str = "props") -> DataFrame:
    """Adds the settings of a descriptor as a map. Later settings win and an
    unpaired tail is dropped.

    Only the first colon ends the type, so ranges such as ``msg=1:-1`` survive.
    The steps are columns of their own: as one nested expression each would be
    repeated for every place that uses it.
    """
    body = F.regexp_replace(F.regexp_replace(_clean(descriptor), r"^[^:]*:?", ""), r"[=;]+\z", "")
    df = df.withColumn("_tokens", F.split(body, "[=;]"))
    count = F.floor(F.size("_tokens") / 2).cast("int")
    df = df.withColumn("_at", F.when(count >= 1, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("_keys", F.transform("_at", lambda i: F.element_at("_tokens", i * 2 - 1)))
    is_last = lambda i: ~F.array_contains(F.slice("_keys", i + 1, F.size("_keys") + 1), F.element_at("_keys", i))
    df = df.withColumn("_at", F.filter("_at", is_last))
    keys = F.transform("_at", lambda i: F.element_at("_keys", i))
    values = F.transform("_at", lambda i: F.element_at("_tokens", i * 2))
    return df.withColumn(name, F.map_from_arrays(keys, values)).drop("_tokens", "_at", "_keys")


def typed_value(value: Column) -> Column:
    """A setting as long, boolean or string; exactly one member is set."""
    digits = is_digits(value)
    boolean = value.isin("true", "false")
    return F.struct(
        F.when(digits, value.try_cast("bigint")).alias("long_value"),
        F.when(boolean, value == "true").alias("bool_value"),
        F.when(~digits & ~boolean, value).alias("string_value"),
    )


def separator_char(word: Column) -> Column:
    """Separator of a ``sep`` setting: absent is byte 1, a word is looked up, and
    any single character stands for itself. NULL marks an unknown word."""
    named = F.when(word.isNull(), F.lit(DEFAULT_SEPARATOR))
    for name, char in SEPARATOR_WORDS.items():
        named = named.when(word == name, F.lit(char))
    return named.when(F.char_length(word) == 1, word)


def _int(text: Column) -> Column:
    return F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("int"))


def with_description(df: DataFrame, descriptor: Column, name: str = "described") -> DataFrame:
    """Adds everything the parser needs from a descriptor, as one struct.

    ``problem`` says why the descriptor cannot be used, or is NULL.
    """
    df = with_props(df, descriptor, "_props")
    prop = {key: F.col("_props")[key] for key in ("ts", "ts_ms", "ts_sec", "msg", "sep")}
    df = df.withColumns({
        "_kind": descriptor_type(descriptor),
        "_ts_ms": F.coalesce(prop["ts"], prop["ts_ms"]),
        "_ts_sec": prop["ts_sec"],
        "_msg": prop["msg"],
        "_sep": prop["sep"],
    })
    is_avro = F.col("_kind") == AVRO_TEXT_TYPE
    df = df.withColumns({
        "_ts": F.coalesce("_ts_ms", "_ts_sec"),
        "_msg": F.when(is_avro, F.col("_msg")).otherwise(F.coalesce(F.col("_msg"), F.lit(DEFAULT_RANGE))),
        "_separator": separator_char(F.col("_sep")),
    })
    df = df.withColumns({
        "_ts_index": _int(F.col("_ts")),
        "_single": is_digits(F.col("_msg")) | (is_avro & (F.col("_msg") == "-1")),
        "_bounds": F.transform(F.split("_msg", ":"), lambda bound: F.trim(bound)),
    })
    df = df.withColumns({
        "_msg_index": F.when(F.col("_single"), F.col("_msg").try_cast("int")),
        "_start_text": F.coalesce(F.get("_bounds", F.lit(0)), F.lit("")),
        "_end_text": F.coalesce(F.get("_bounds", F.lit(1)), F.lit("")),
    })
    df = df.withColumns({
        "_start": F.when(F.col("_start_text") == "", F.lit(0)).otherwise(_int(F.col("_start_text"))),
        "_end": F.when(F.col("_end_text") == "", F.lit(-1)).otherwise(_int(F.col("_end_text"))),
    })
    single = F.col("_single")
    problem = (
        F.when(~F.col("_kind").isin(TEXT_TYPE, AVRO_TEXT_TYPE), F.concat(F.lit("no parser for format type "), F.col("_kind")))
        .when(F.col("_ts").isNull(), F.lit(NO_TIME_FIELD))
        .when(F.col("_ts_index").isNull(), F.concat(F.lit("time field is not an index: "), F.col("_ts")))
        .when(is_avro & F.col("_msg_index").isNull(), F.lit("format names no msg index"))
        .when(single & F.col("_msg_index").isNull(), F.concat(F.lit("message field is not an index: "), F.col("_msg")))
        .when(~single & (F.col("_start").isNull() | F.col("_end").isNull()), F.concat(F.lit("message range is not start:end: "), F.col("_msg")))
        .when((F.col("_kind") == TEXT_TYPE) & F.col("_separator").isNull(), F.concat(F.lit("unknown separator "), F.col("_sep")))
    )
    described = F.struct(
        F.col("_kind").alias("type"),
        F.coalesce(F.col("_separator"), F.lit("")).alias("separator"),
        split_pattern(F.col("_separator")).alias("split_on"),
        F.col("_ts_index").alias("ts_index"),
        F.when(F.col("_ts_ms").isNotNull(), F.lit(1)).otherwise(F.lit(1000)).alias("ts_scale"),
        F.col("_msg_index").alias("msg_index"),
        F.when(~single, F.greatest(F.lit(0), F.col("_start"))).alias("msg_start"),
        F.when(~single, F.greatest(F.lit(-1), F.col("_end"))).alias("msg_end"),
        problem.alias("problem"),
    )
    steps = ["_props", "_kind", "_ts_ms", "_ts_sec", "_msg", "_sep", "_ts", "_separator", "_ts_index", "_single",
             "_bounds", "_msg_index", "_start_text", "_end_text", "_start", "_end"]
    return df.withColumn(name, described).drop(*[s for s in steps if s != name])


_LOADED: dict[str, Row] = {}


def load_descriptor(spark: SparkSession, text: str) -> Row:
    """Describe one descriptor now, on the driver, for use as literals in a plan."""
    if text not in _LOADED:
        row = with_description(spark.sql("SELECT :text AS d", {"text": text}), F.col("d")).first()
        _LOADED[text] = row["described"]
    return _LOADED[text]


def descriptor_literals(described: Row) -> dict[str, Column]:
    """A loaded descriptor as constant columns."""
    types = {"ts_index": "int", "ts_scale": "int", "msg_index": "int", "msg_start": "int", "msg_end": "int"}
    return {k: F.lit(v).cast(types.get(k, "string")) for k, v in described.asDict().items()}
