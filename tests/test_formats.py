import datetime as dt

import pytest
from pyspark.sql import functions as F

from rillflow.functions import descriptors, event_time, text
from rillflow.operators.parse import parse_with_column, parse_with_descriptor

LINE = "7|north gate|open|488412345|ok"
ALL = LINE.split("|")


def messages(spark, *values, topic="test"):
    return spark.createDataFrame([(topic, bytearray(v if isinstance(v, bytes) else v.encode())) for v in values], "topic string, value binary")


def parse_one(spark, descriptor, value=LINE):
    return parse_with_descriptor(messages(spark, value), descriptor).first()


def test_descriptor_type_and_props(spark):
    df = spark.createDataFrame(
        [("txt:ts=0;sep=byte1",), ("txt",), (None,), ("a:k=1;k=2;tail",), ("t:a;b=c",), ("txt:msg=1:-1;ts=0",), ("txt:x=",), ("txt:ts=0;msg=2:",)],
        "d string",
    )
    df = descriptors.with_props(df, F.col("d"), "p")
    rows = df.select(descriptors.descriptor_type(F.col("d")).alias("t"), "p").collect()
    assert [(r["t"], r["p"]) for r in rows] == [
        ("txt", {"ts": "0", "sep": "byte1"}),
        ("txt", {}),
        ("txt", {}),
        ("a", {"k": "2"}),
        ("t", {"a": "b"}),
        ("txt", {"msg": "1:-1", "ts": "0"}),
        ("txt", {}),
        ("txt", {"ts": "0", "msg": "2"}),
    ]


def test_typed_values(spark):
    df = spark.createDataFrame([("0",), ("-1",), ("true",), ("false",), ("byte1",)], "v string")
    rows = [tuple(r["t"]) for r in df.select(descriptors.typed_value(F.col("v")).alias("t")).collect()]
    assert rows == [(0, None, None), (None, None, "-1"), (None, True, None), (None, False, None), (None, None, "byte1")]


@pytest.mark.parametrize("word,char", [*descriptors.SEPARATOR_WORDS.items(), (",", ","), ("#", "#"), ("\\", "\\"), ("x", "x"), ("7", "7"), ("^", "^")])
def test_separators(spark, word, char):
    row = parse_one(spark, f"txt:sep={word};ts=0;msg=1:-1", f"1{char}hi{char}{char}yo")
    assert (row["error"], row["fields"], row["message"]) == (None, ["hi", "yo"], f"hi{char}yo")


def test_default_separator_and_index(spark):
    row = parse_one(spark, "txt:ts=0;sep=byte1;msg=1", "1459000000000\u0001hi")
    assert row["message"] == "hi" and row["ts_ms"] == 1459000000000
    assert parse_one(spark, "txt:ts=0;msg=1", "1459000000000\u0001hi")["message"] == "hi"


def test_time_in_millis_and_seconds(spark):
    row = parse_one(spark, "txt:sep=pipe;ts=3;msg=1")
    assert row["ts_ms"] == 488412345 and row["fields"] == ["north gate"]
    row = parse_one(spark, "txt:sep=pipe;ts_sec=3;msg=1")
    assert row["ts_ms"] == 488412345000 and row["fields"] == ["north gate"]
    row = parse_one(spark, "txt:sep=pipe;ts_sec=3;ts_ms=0;msg=1")
    assert row["ts_ms"] == 7


def test_time_now(spark):
    row = parse_one(spark, "txt:sep=pipe;ts_sec=-1;msg=1")
    now = dt.datetime.now(dt.timezone.utc).timestamp() * 1000
    assert abs(now - row["ts_ms"]) < 120_000


@pytest.mark.parametrize(
    "msg,expected",
    [
        ("-1:-1", ALL), ("-1:-9", ALL), ("-55:-7", ALL), ("-1:", ALL), (":-1", ALL), ("-1", ALL),
        ("2:-1", ALL[2:]), ("2:4", ALL[2:4]), ("2:3", ALL[2:3]), ("2:2", ALL[2:3]), ("2:1", ALL[2:3]),
        ("2:640", ALL[2:]), ("7000:900", []), ("2147483647:2147483647", []), (" 1 : 2 ", ALL[1:2]),
    ],
)
def test_field_ranges(spark, msg, expected):
    row = parse_one(spark, f"txt:sep=pipe;ts_sec=-1;msg={msg}")
    assert row["error"] is None and row["fields"] == expected


@pytest.mark.parametrize("msg,expected", [(":", 2), ("0:", 2), (":-1", 2), (":-640", 2), (":70000", 2), ("0:1", 1), ("0", 1)])
def test_array_cases(spark, msg, expected):
    row = parse_one(spark, f"txt:sep=comma;msg={msg};ts=-1", "red,blue")
    assert row["fields"] == ["red", "blue"][:expected]


def test_second_field(spark):
    assert parse_one(spark, "txt:sep=comma;msg=1;ts=-1", "red,blue")["fields"] == ["blue"]


def test_separator_runs_and_empty_line(spark):
    df = spark.createDataFrame([("||a||b|",), ("",), ("|||",)], "t string")
    rows = [r[0] for r in df.select(text.split_fields(F.col("t"), "\\|")).collect()]
    assert rows == [["a", "b"], [], []]


@pytest.mark.parametrize(
    "descriptor,value,error",
    [
        ("txt", "a", descriptors.NO_TIME_FIELD),
        ("json:ts=0", "a", "no parser for format type json"),
        ("txt:sep=wat;ts=0", "1", "unknown separator wat"),
        ("txt:sep=pipe;ts=x", "1", "time field is not an index: x"),
        ("txt:sep=pipe;ts=0;msg=a:b", "1|2", "message range is not start:end: a:b"),
        ("txt:sep=pipe;ts=0;msg=99999999999", "1|2", "message field is not an index: 99999999999"),
        ("txt:sep=pipe;ts=5", "1|2", "time field is past the last field"),
        ("txt:sep=pipe;ts=0", "", "time field is past the last field"),
        ("txt:sep=pipe;ts=1", "1|later", "time field is not a time"),
        ("txt:sep=pipe;ts=0", "99999999999999999999|a", "time field is not a time"),
        ("txt:sep=pipe;ts=0", "9999999999999999|a", "time field is not a time"),
        ("txt:sep=pipe;ts_sec=0", "9223372036854775807|a", "time field is not a time"),
        ("txt:sep=pipe;ts=0;msg=2", "1|a", "message field is past the last field"),
        ("txt:sep=pipe;ts=0;msg=3", "1|a", "message field is past the last field"),
        ("avro-txt:ts=0;msg=1", "x", "no Avro schema given for the topic"),
    ],
)
def test_bad_rows_are_kept_with_an_error(spark, descriptor, value, error):
    row = parse_one(spark, descriptor, value)
    assert row["error"] == error and row["ts"] is None and row["fields"] is None
    assert bytes(row["value"]) == value.encode()
    by_column = parse_with_column(messages(spark, value), F.lit(descriptor)).first()
    assert by_column == row


def test_malformed_bytes_do_not_fail(spark):
    row = parse_one(spark, "txt:sep=pipe;ts=0;msg=1", b"7|a\xffb")
    assert row["message"] == "a�b"


@pytest.mark.parametrize(
    "value,millis",
    [
        ("2016-03-20T09:10:11.123Z", 1458465011123),
        ("2016-03-20T09:10:11Z", 1458465011000),
        ("2016-03-20T11:10:11+02:00", 1458465011000),
        ("2016-03-20T11:10:11+0200", 1458465011000),
        ("2016-03-20 09:10:11", 1458465011000),
        ("2016-03-20T09:10:11", 1458465011000),
        ("2016-03-20T09:10", 1458465000000),
        ("2016-03-20T09", 1458464400000),
        ("2016-03-20", 1458432000000),
        ("2016-03", 1456790400000),
        ("20160320T091011.123Z", 1458465011123),
        ("20160320T091011Z", 1458465011000),
        ("2016-080", 1458432000000),
        ("2016-W11-7", 1458432000000),
        ("2016-W11", 1457913600000),
        ("20160320", 20160320),
        ("-5", None), ("2016-13-40", None), ("nine", None), (" 5", None), ("5\n", None),
    ],
)
def test_time_texts(spark, value, millis):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(event_time.to_millis(F.col("v"))).first()[0] == millis


def test_literals_leave_no_descriptor_work_in_the_plan(spark):
    parsed = parse_with_descriptor(messages(spark, LINE), "txt:sep=pipe;ts=3;msg=0:3")
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "map_from_entries" not in plan and "transform(" not in plan
