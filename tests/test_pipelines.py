import random
import re

import pytest
from pyspark.sql import functions as F

from rillflow.plans.pipelines import (
    TYPE, BatchPlugin, ColumnPlugin, Compose, Context, FanOut, FunctionPlugin, Match, Plugin, Retag, SideEffect, build_pipeline,
)


class IncColumn(ColumnPlugin):
    def exec(self, columns):
        return {"msg": columns["msg"] + 1}


class IncBatch(BatchPlugin):
    def exec(self, type_name, batch):
        return batch.assign(msg=(batch["msg"] + 1).astype("int64"))


class IncFrame(Plugin):
    def apply(self, df):
        return df.withColumn("msg", F.col("msg") + 1)


DEFINITION = ["->", "a", "b", ["match", "double", "c"], ["all", "d"]]


def rows(spark, *types):
    return spark.createDataFrame([(t, 0) for t in types], f"{TYPE} string, msg bigint")


def result(df):
    return {r[TYPE]: r["msg"] for r in df.collect()}


@pytest.mark.parametrize("plugin", [IncColumn, IncBatch, IncFrame])
def test_three_kinds_of_plugin(spark, plugin):
    built = build_pipeline({"plugins": dict.fromkeys("abcd", plugin), "pipeline": DEFINITION})
    assert result(built.apply(rows(spark, "single", "double"))) == {"single": 3, "double": 4}


def test_random_number_of_steps(spark):
    n = random.Random(5).randint(2, 30)
    seen = []

    def step(i):
        def run(df):
            seen.append(i)
            return df.withColumn("msg", F.col("msg") + 1)
        return FunctionPlugin(run)

    assert result(Compose([step(i) for i in range(n)]).apply(rows(spark, "x"))) == {"x": n}
    assert seen == list(range(n))


def test_random_number_of_routes(spark):
    ids = [f"id-{random.Random(i).randint(0, 10**9)}-{i}" for i in range(12)]
    routes = [(name, ColumnPlugin(lambda c, i=i: {"msg": c["msg"] + i})) for i, name in enumerate(ids, 1)]
    got = result(Match(routes).apply(rows(spark, *ids, "none")))
    assert got == {**{name: i for i, name in enumerate(ids, 1)}, "none": 0}


def test_every_branch_runs_once_and_input_passes(spark):
    for n in range(2, 6):
        calls = []
        branches = [SideEffect(lambda df, i=i: calls.append((i, df.count()))) for i in range(n)]
        assert result(FanOut(branches).apply(rows(spark, "x"))) == {"x": 0}
        assert calls == [(i, 1) for i in range(n)]


def test_match_order_null_types_and_patterns(spark):
    df = spark.createDataFrame([("abc", 0), (None, 0), ("zz", 0)], f"{TYPE} string, msg bigint")
    inc = lambda k: ColumnPlugin(lambda c: {"msg": c["msg"] + k})
    routes = [(re.compile("b"), inc(1)), ("abc", inc(100)), (re.compile("^z+$"), inc(7))]
    assert result(Match(routes).apply(df)) == {"abc": 1, None: 0, "zz": 7}
    general = [(m, FunctionPlugin(s.apply)) for m, s in routes]
    assert result(Match(general).apply(df)) == {"abc": 1, None: 0, "zz": 7}


def test_match_may_add_a_column(spark):
    df = Match([("a", ColumnPlugin(lambda c: {"extra": F.lit("x")}))]).apply(rows(spark, "a", "b"))
    assert {r[TYPE]: r["extra"] for r in df.collect()} == {"a": "x", "b": None}


def test_match_of_columns_scans_once(spark):
    df = Match([("a", IncColumn()), ("b", Compose([IncColumn(), IncColumn()])), (re.compile("c"), Retag("d"))]).apply(rows(spark, "a", "b", "c"))
    assert "Union" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert result(df) == {"a": 1, "b": 2, "d": 0}


@pytest.mark.parametrize("pipeline", [["match", re.compile("[a-z]")], ["->", "nobody"], ["first", "a"]])
def test_bad_definitions(pipeline):
    with pytest.raises(ValueError):
        build_pipeline({"plugins": {"a": IncColumn}, "pipeline": pipeline})


def test_default_pipeline_and_context(spark):
    written = []
    ctx = Context({"x": 1}, {"disk-writer": SideEffect(lambda df: written.append(df.count()))})
    assert result(build_pipeline(None, ctx).apply(rows(spark, "a"))) == {"a": 0} and written == [1]
    assert result(build_pipeline({"pipeline": []}).apply(rows(spark, "a"))) == {"a": 0}


def test_life_cycle():
    events = []

    class Life(Plugin):
        def init(self, ctx):
            events.append(("init", ctx.conf["x"]))

        def shutdown(self):
            events.append("shutdown")

    built = build_pipeline({"plugins": {"a": Life}, "pipeline": ["->", "a"]}, Context({"x": 1}))
    built.close()
    assert events == [("init", 1), "shutdown"]


def test_batch_plugin_set_up_per_partition(spark, tmp_path):
    class Marked(BatchPlugin):
        def setup(self):
            self.ready = True

        def exec(self, type_name, batch):
            return batch.assign(msg=1 if self.ready else 0)

        def teardown(self):
            (tmp_path / "done").write_text("yes")

    assert result(Marked().apply(rows(spark, "a"))) == {"a": 1}
    assert (tmp_path / "done").read_text() == "yes"


def test_pattern_flags(spark):
    df = rows(spark, "Ab", "ab", "x\ny")
    got = Match([(re.compile("^A", re.I), Retag("a")), (re.compile("x.y", re.S), Retag("s"))]).apply(df)
    assert sorted(r["type"] for r in got.collect()) == ["a", "a", "s"]
    for refused in (re.compile("(?P<n>a)"), re.compile("a", re.A)):
        with pytest.raises(ValueError):
            Match([(refused, Retag("a"))]).apply(df)


def _source(spark, tmp_path):
    path = str(tmp_path / "source")
    rows(spark, "a", "a", "b", "c").withColumn("_route", F.lit("mine")).write.parquet(path)
    return path, spark.read.parquet(path)


@pytest.mark.parametrize("matcher", ["match", "all"])
def test_branches_read_their_input_once(spark, tmp_path, matcher):
    path, df = _source(spark, tmp_path)
    computed = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            computed.add(len(frame))
            yield frame

    seen = []

    class Keep(Plugin):
        def apply(self, df):
            seen.append(df.count())
            return df.withColumn("msg", F.col("msg") + 1)

    branches = {"match": ["match", "a", "k", "b", "k"], "all": ["all", "k", "k"]}[matcher]
    built = build_pipeline({"plugins": {"k": Keep()}, "pipeline": branches})
    out = built.apply(df.mapInPandas(count, df.schema).withColumn("empty", F.lit(None)))
    assert out.columns == [*df.columns, "empty"]
    assert seen == ([2, 1] if matcher == "match" else [4, 4])
    assert not [f for f in out.inputFiles() if path in f]
    got = sorted((r[TYPE], r["msg"], r["_route"], r["empty"]) for r in out.collect())
    plus = int(matcher == "match")
    assert got == [("a", plus, "mine", None)] * 2 + [("b", plus, "mine", None), ("c", 0, "mine", None)]
    assert computed.value == 4
    if matcher == "match":
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"PartitionFilters: \[isnotnull\(_route_#\d+\), \(_route_#\d+ = ", plan)) == 3
    folders = list(built.branching[0].staged)
    built.remove_staged(df)
    for folder in folders:
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(folder)
