"""Publishing by manifest: what readers see between the steps of publishers, compactions and clean-ups."""

import pytest
from pyspark.sql import functions as F

from rillflow.operators.catalog import make_catalog
from rillflow.plans import versions
from rillflow.sources.store import names_in


def catalog_of(spark, root, base="a"):
    return make_catalog(spark, [{"log": t, "base_partition": f"{root}/{base}", "log_partition": "all", "date_format": "datehour"} for t in ("x", "y")])


def rows_of(spark, *lines, hour="2024-01-01-05", topic="x"):
    return spark.createDataFrame([(topic, hour, line) for line in lines], "topic string, hour string, value string")


def publish(spark, root, name, *lines, base="a", commit=True, **where):
    rows = rows_of(spark, *lines, **where)
    written = versions.write_increment(rows, rows, catalog_of(spark, root, base), f"{root}/log", name, writers=1)
    if commit:
        versions.commit(written)
    return written


def seen(spark, root):
    return sorted(r["value"] for r in versions.read_published(spark, f"{root}/log").collect())


def files(spark, root):
    return versions.live_files(spark, f"{root}/log").count()


def test_increments_are_seen_at_once_and_replaced_by_name(spark, tmp_path):
    root = str(tmp_path)
    assert seen(spark, root) == [] and not versions.compact(spark, f"{root}/log")
    half = publish(spark, root, "p", "one", "two", commit=False)
    assert seen(spark, root) == []
    publish(spark, root, "q", "three", topic="y")
    versions.commit(half)
    assert seen(spark, root) == ["one", "three", "two"]
    publish(spark, root, "p", "four", base="b")
    assert seen(spark, root) == ["four", "three"]
    assert versions.remove_unseen(spark, f"{root}/log") == 1 and seen(spark, root) == ["four", "three"]
    # An attempt without rows takes the old ones away.
    publish(spark, root, "p")
    assert seen(spark, root) == ["three"]
    publish(spark, root, "r", "lost", hour="no hour")
    assert seen(spark, root) == ["three"]
    with pytest.raises(ValueError):
        publish(spark, root, "a/b", "x")


def test_compaction_beside_publishers(spark, tmp_path):
    root = str(tmp_path)
    for i in range(4):
        publish(spark, root, f"p{i}", f"line {i}")
    first = versions.write_compaction(spark, f"{root}/log")
    second = versions.write_compaction(spark, f"{root}/log")
    publish(spark, root, "late", "line 4")
    versions.commit(first)
    assert files(spark, root) == 2 and seen(spark, root) == [f"line {i}" for i in range(5)]
    # A publication that is run again outdates what was joined with it; its own files are fallen back to.
    publish(spark, root, "p1", "line 1, again")
    assert seen(spark, root) == ["line 0", "line 1, again", "line 2", "line 3", "line 4"] and files(spark, root) == 5
    versions.compact(spark, f"{root}/log")
    assert files(spark, root) == 1 and len(seen(spark, root)) == 5
    # Joined files are joined again with later ones, sources and all.
    publish(spark, root, "later", "line 5")
    versions.compact(spark, f"{root}/log")
    assert files(spark, root) == 1 and len(seen(spark, root)) == 6
    publish(spark, root, "p0", "line 0, again")
    assert seen(spark, root) == ["line 0, again", "line 1, again", "line 2", "line 3", "line 4", "line 5"]
    assert second.publication != first.publication


def test_two_compactions_of_the_same_files(spark, tmp_path):
    root = str(tmp_path)
    for i in range(3):
        publish(spark, root, f"p{i}", f"line {i}")
    both = [versions.write_compaction(spark, f"{root}/log") for _ in range(2)]
    assert versions.commit(both[0]) and len(seen(spark, root)) == 3
    assert not versions.commit(both[1])
    assert seen(spark, root) == ["line 0", "line 1", "line 2"]


def test_cleaned_publications_are_closed(spark, tmp_path):
    root = str(tmp_path)
    for i in range(3):
        publish(spark, root, f"p{i}", f"line {i}")
    versions.compact(spark, f"{root}/log")
    assert versions.remove_unseen(spark, f"{root}/log") == 3 and len(names_in(spark, f"{root}/a/{versions.FILES}")) == 1
    with pytest.raises(ValueError, match="cannot be published again"):
        publish(spark, root, "p1", "other")
    publish(spark, root, "p3", "line 3")
    assert len(seen(spark, root)) == 4
    publish(spark, root, "stopped", "never seen", commit=False)
    assert versions.remove_unseen(spark, f"{root}/log") == 0 and versions.remove_unseen(spark, f"{root}/log", unfinished=True) == 1
    assert len(seen(spark, root)) == 4


def test_bins_follow_the_bytes(spark, tmp_path):
    root = str(tmp_path)
    for i in range(6):
        publish(spark, root, f"p{i}", *[f"{i} {j * 7919 % 1013}" for j in range(200)])
    lengths = [r["length"] for r in versions.live_files(spark, f"{root}/log").collect()]
    target = sum(lengths) // 3 + 1
    assert versions.compact(spark, f"{root}/log", target)
    assert files(spark, root) == 3 and len(seen(spark, root)) == 1200
    # What is as large as it may be is left alone.
    assert not versions.compact(spark, f"{root}/log", 1)
    assert versions.compact(spark, f"{root}/log", whole=True) and files(spark, root) == 1


def test_places_share_a_base_and_keep_apart(spark, tmp_path):
    root = str(tmp_path)
    for i, hour in enumerate(("2024-01-01-05", "2024-01-01-06", "2024-01-01-05", "2024-01-01-06")):
        publish(spark, root, f"p{i}", f"{hour} {i}", hour=hour)
    versions.compact(spark, f"{root}/log")
    got = versions.read_published(spark, f"{root}/log").select(F.regexp_extract("place", "hour=(.*)$", 1).alias("h"), "value").collect()
    assert sorted(map(tuple, got)) == [("2024010105", "2024-01-01-05 0"), ("2024010105", "2024-01-01-05 2"), ("2024010106", "2024-01-01-06 1"), ("2024010106", "2024-01-01-06 3")]


def test_lines_of_switched_partitions_are_not_broadcast(spark, tmp_path):
    from rillflow.queries import all_queries

    events = spark.range(40).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 2 * 86_400 + F.col("id") % 3 * 3600).alias("ts"),
        F.lit(1).cast("bigint").alias("user_id"), F.when(F.col("id") < 30, "click").otherwise("view").alias("event_type"),
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = all_queries()["switched_partitions"].run(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan
    assert sorted(map(tuple, found.collect())) == [("20240101", "ok", 15), ("20240102", "ok", 15)]
