import math

from pyspark.sql import functions as F

from rillflow.operators import metrics
from rillflow.operators.quality import flagged_topics
from rillflow.sinks import reports


def test_rates_equal_step_by_step_averages(spark):
    minutes = [0, 1, 2, 3, 7, 150, 199, 200, 201, 399, 400, 1000, 1001, 5000]
    per_minute = {m: 1 + (m * 7) % 11 for m in minutes}
    data = [("t", m * 60 + i) for m, n in per_minute.items() for i in range(n)] + [("u", 61)]
    rows = spark.createDataFrame(data, "topic string, s bigint").select("topic", F.timestamp_seconds("s").alias("ts"))
    got = {r["minute_index"]: r for r in metrics.message_rates(rows).filter("topic = 't'").collect()}
    assert sorted(got) == minutes
    total, averages = 0, {name: None for name in metrics.RATE_WINDOWS}
    for m in range(5001):
        n = per_minute.get(m, 0)
        total += n
        for name, window in metrics.RATE_WINDOWS.items():
            old, alpha = averages[name], 1 - math.exp(-1 / window)
            averages[name] = n / 60 if old is None else old + alpha * (n / 60 - old)
        if m in got:
            assert got[m]["count"] == total
            assert math.isclose(got[m]["mean_rate"], total / ((m + 1) * 60))
            for name in averages:
                assert math.isclose(got[m][name], averages[name], rel_tol=1e-9, abs_tol=1e-15), (m, name)


def test_load_stats(spark):
    runs = spark.createDataFrame([(100, 50), (300, 50)], "elapsed_ms bigint, messages bigint")
    row = metrics.load_stats(runs).first()
    assert (row["runs"], row["messages"], row["mean_ms"], row["max_ms"], row["min_ms"], row["rate_per_sec"]) == (2, 100, 200.0, 300, 100, 500)
    none = metrics.load_stats(runs.filter("false")).first()
    assert (none["runs"], none["mean_ms"], none["rate_per_sec"]) == (0, 0.0, None)


def test_flags_count_anew(spark):
    errors = {"a": 100, "b": 101, "c": 250}
    rows = spark.createDataFrame([(t, "e") for t, n in errors.items() for _ in range(n)] + [("a", None)] * 500, "topic string, error string")
    got = {r["topic"]: (r["errors"], r["times_flagged"], r["errors_left"]) for r in flagged_topics(rows).collect()}
    assert got == {"b": (101, 1, 0), "c": (250, 2, 48)}


def test_counters_expire_a_day_after_their_last_increment(spark, tmp_path):
    counters = spark.createDataFrame([("in", "a", "201603200910", 5)], "phase string, topic string, minute string, n bigint")
    for batch in ("1", "2", "2"):
        reports.publish_counters(counters, str(tmp_path), "q", batch)
    assert [r["n"] for r in reports.live_counters(spark, str(tmp_path)).collect()] == [10]
    later = F.current_timestamp() + F.expr("INTERVAL 23 HOURS")
    assert reports.live_counters(spark, str(tmp_path), later).count() == 1
    later = F.current_timestamp() + F.expr("INTERVAL 25 HOURS")
    assert reports.live_counters(spark, str(tmp_path), later).count() == 0
