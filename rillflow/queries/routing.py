"""Plugin queries: composition, routing, fan-out, batches."""

from __future__ import annotations

import re

from pyspark.sql import Observation
from pyspark.sql import functions as F

from rillflow.plans.pipelines import (
    TYPE,
    BatchPlugin,
    ColumnPlugin,
    Compose,
    FanOut,
    FunctionPlugin,
    Match,
    Observe,
    Retag,
    SideEffect,
    build_pipeline,
    replace_payload,
    single_message,
)
from rillflow.queries import Registry
from rillflow.queries.feeds import events
from rillflow.session import work_dir

QUERIES = Registry()


def _typed(spark, sf_dir):
    return events(spark, sf_dir).select(F.col("event_type").alias(TYPE), "event_id", F.col("user_id").alias("n"))


class Add(ColumnPlugin):
    """Adds a number to the payload."""

    def __init__(self, number: int = 1):
        super().__init__(lambda columns: {"n": columns["n"] + number})


class BatchAdd(BatchPlugin):
    def exec(self, type_name, batch):
        return batch.assign(n=batch["n"] + 1)


@QUERIES.add("SELECT event_type AS type, event_id, user_id + 111 AS n FROM events")
def pipe_compose(spark, sf_dir):
    return _typed(spark, sf_dir).transform(Compose([Add(1), Add(10), Add(100)]))


@QUERIES.add("SELECT event_type AS type, event_id, user_id AS n FROM events")
def pipe_empty(spark, sf_dir):
    return _typed(spark, sf_dir).transform(Compose([Compose([]), FanOut([]), Match([])]))


_MATCH_SQL = """
    SELECT event_type AS type, event_id,
           user_id + CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 30 WHEN 'error' THEN 200 ELSE 0 END AS n FROM events"""


@QUERIES.add(_MATCH_SQL)
def pipe_match(spark, sf_dir):
    """Exact matches as column expressions: one scan. The first listed wins."""
    routes = [("click", Add(1)), ("view", Compose([Add(10), Add(20)])), ("error", FanOut([Add(200)])), ("click", Add(5000))]
    return _typed(spark, sf_dir).transform(Match(routes))


@QUERIES.add(_MATCH_SQL)
def pipe_match_split(spark, sf_dir):
    """The same routes through general DataFrame plugins."""
    def add(number):
        return FunctionPlugin(lambda df: df.withColumn("n", F.col("n") + number))

    return _typed(spark, sf_dir).transform(Match([("click", add(1)), ("view", add(30)), ("error", add(200)), ("click", add(5000))]))


@QUERIES.add("""
    SELECT event_type AS type, event_id,
           user_id + CASE WHEN event_type = 'signup' THEN 1 WHEN regexp_matches(event_type, 'i[ce]|^p') THEN 20 ELSE 0 END AS n
    FROM events""")
def pipe_match_regex(spark, sf_dir):
    """A pattern matches anywhere in the type."""
    return _typed(spark, sf_dir).transform(Match([("signup", Add(1)), (re.compile("i[ce]|^p"), Add(20))]))


@QUERIES.add("""
    SELECT CASE WHEN event_type = 'error' THEN 'alerts/error' ELSE event_type END AS type, event_id, user_id AS n FROM events""")
def pipe_retag(spark, sf_dir):
    return _typed(spark, sf_dir).transform(Match([("error", Retag(F.concat(F.lit("alerts/"), F.col(TYPE))))]))


@QUERIES.add("SELECT event_type AS type, event_id || ':' || user_id AS body FROM events")
def pipe_payload(spark, sf_dir):
    return replace_payload(_typed(spark, sf_dir), body=F.concat_ws(":", "event_id", "n"))


@QUERIES.add("SELECT event_type AS type, min(event_id) AS event_id, arg_min(user_id, event_id) AS n FROM events GROUP BY 1")
def pipe_first(spark, sf_dir):
    return single_message(_typed(spark, sf_dir), ["event_id"])


@QUERIES.add("SELECT event_type AS type, event_id, user_id + 1 AS n FROM events")
def pipe_batch(spark, sf_dir):
    return _typed(spark, sf_dir).transform(BatchAdd())


@QUERIES.add("""
    SELECT event_type AS type, event_id, unnest([user_id, user_id * 2]) AS n FROM events WHERE event_type <> 'view'""")
def pipe_batch_rows(spark, sf_dir):
    """A batch plugin that drops one type and doubles the rows of the others."""
    import pandas as pd

    def twice(type_name, batch):
        if type_name == "view":
            return batch.head(0)
        return pd.concat([batch, batch.assign(n=batch["n"] * 2)])

    return _typed(spark, sf_dir).transform(BatchPlugin(twice))


@QUERIES.add("""
    SELECT event_type AS type, event_id, user_id + CASE event_type WHEN 'click' THEN 4 ELSE 3 END AS n FROM events""")
def pipe_definition(spark, sf_dir):
    """The usual definition: three steps for every type, four for one of them."""
    built = build_pipeline({
        "plugins": {"a": Add, "b": Add(), "c": lambda df: df.withColumn("n", F.col("n") + 1), "d": BatchAdd},
        "pipeline": ["->", "a", "b", ["match", "click", "c"], ["all", "d"]],
    })
    return _typed(spark, sf_dir).transform(built)


@QUERIES.add("""
    SELECT branch, event_type AS type, count(*) AS n, sum(event_id) AS ids
    FROM events, (VALUES ('first'), ('second'), ('through')) b(branch)
    WHERE branch <> 'second' OR event_type = 'click' GROUP BY 1, 2""")
def pipe_fanout(spark, sf_dir):
    """Two branches that write, each run once; the input passes through."""
    path = work_dir(spark, "fanout")
    first = SideEffect(lambda df: df.write.parquet(f"{path}/first"))
    second = Compose([
        FunctionPlugin(lambda df: df.filter(F.col(TYPE) == "click")),
        SideEffect(lambda df: df.write.parquet(f"{path}/second")),
    ])
    through = _typed(spark, sf_dir).transform(FanOut([first, second]))
    parts = {"first": spark.read.parquet(f"{path}/first"), "second": spark.read.parquet(f"{path}/second"), "through": through}
    counted = [
        df.groupBy(F.lit(name).alias("branch"), TYPE).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
        for name, df in parts.items()
    ]
    return counted[0].unionAll(counted[1]).unionAll(counted[2])


@QUERIES.add("""
    SELECT event_type AS type, count(*) AS n, (SELECT count(*) FROM events) AS seen, (SELECT sum(user_id) FROM events) AS total
    FROM events GROUP BY 1""")
def pipe_observe(spark, sf_dir):
    """Metrics gathered while the rows flow through to a written table."""
    path = work_dir(spark, "observed")
    seen = Observation("rows")
    step = Observe(seen, F.count(F.lit(1)).alias("seen"), F.sum("n").alias("total"))
    _typed(spark, sf_dir).transform(step).write.parquet(path)
    counted = spark.read.parquet(path).groupBy(TYPE).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumns({name: F.lit(value) for name, value in seen.get.items()})
