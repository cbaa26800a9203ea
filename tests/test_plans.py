"""The physical plans stay the ones meant for large inputs."""

import re

import pytest
from pyspark.sql import functions as F

from rillflow.operators.metrics import topic_hour_counts
from rillflow.operators.parse import parse_messages, parse_with_descriptor
from rillflow.operators.quality import keyed_rows, split_by_error, with_hour_key
from rillflow.plans.ingest import parsed_rows
from rillflow.queries.feeds import event_catalog, event_messages

SF_DIR = "/root/testdata/sf0.001"

# The JVM does not compile larger methods.
JIT_LIMIT = 8000


def generated(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        return plan.toString(), [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("make", [
    lambda m, c: parse_messages(m, c),
    lambda m, c: split_by_error(parsed_rows(m, c)).good,
    lambda m, c: topic_hour_counts(keyed_rows(with_hour_key(parse_messages(m, c)))),
    lambda m, c: keyed_rows(with_hour_key(parse_with_descriptor(m, "txt:sep=pipe;ts=3;msg=0:3"))),
])
def test_generated_methods_can_be_compiled(spark, make):
    _, sizes = generated(spark, make(event_messages(spark, SF_DIR), event_catalog(spark)))
    assert sizes and max(sizes) < JIT_LIMIT


def test_parsing_needs_no_shuffle_and_no_python(spark):
    plan, _ = generated(spark, split_by_error(parsed_rows(event_messages(spark, SF_DIR), event_catalog(spark))).good)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Python" not in plan


def test_counts_combine_before_the_only_shuffle(spark):
    plan, _ = generated(spark, topic_hour_counts(with_hour_key(parse_with_descriptor(event_messages(spark, SF_DIR), "txt:sep=pipe;ts=3"))))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
    assert "props" not in plan and "value#" not in plan.split("FileScan")[1]


def test_topic_filter_reaches_the_scan(spark):
    parsed = parse_with_descriptor(event_messages(spark, SF_DIR), "txt:sep=pipe;ts=3").filter(F.col("topic") == "click")
    plan, _ = generated(spark, parsed)
    assert "EqualTo(event_type,click)" in plan
