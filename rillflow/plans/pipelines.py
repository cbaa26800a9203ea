"""Composable pipelines: plugins joined by ``->``, ``all`` and ``match``.

Messages are rows with a ``type`` column and payload columns. A plugin turns one
DataFrame into another, so a pipeline is one logical plan that Catalyst
optimises as a whole. Plugins that only rewrite columns stay column
expressions, also behind a ``match``: routing among them costs no extra scan.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType

from rillflow.session import work_dir
from rillflow.sources.store import remove

TYPE = "type"

COMPOSE = "->"
ALL = "all"
MATCH = "match"


@dataclass
class Context:
    """Configuration and named plugins shared by the plugins of a pipeline."""

    conf: Mapping[str, object] = field(default_factory=dict)
    plugins: dict[str, "Plugin"] = field(default_factory=dict)


class Plugin:
    """A step from DataFrame to DataFrame."""

    def init(self, ctx: Context) -> None:
        """Called once, when the pipeline is built."""

    def shutdown(self) -> None:
        """Called once, when the pipeline is closed."""

    def apply(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.apply(df)


class FunctionPlugin(Plugin):
    def __init__(self, function: Callable[[DataFrame], DataFrame]):
        self.function = function

    def apply(self, df: DataFrame) -> DataFrame:
        return self.function(df)


class ColumnPlugin(Plugin):
    """One row in, one row out, as column expressions.

    ``exec(columns)`` gets the current expression of every column and returns
    the columns it replaces or adds.
    """

    def __init__(self, exec: Callable[[Mapping[str, Column]], Mapping[str, Column]] | None = None):
        self._exec = exec

    def exec(self, columns: Mapping[str, Column]) -> Mapping[str, Column]:
        if self._exec is None:
            raise NotImplementedError
        return self._exec(columns)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(dict(self.exec({c: F.col(f"`{c}`") for c in df.columns})))


class BatchPlugin(Plugin):
    """A function over the rows of one type in an Arrow batch; it may change the
    number of rows.

    Batches are cut wherever Spark cuts them: a type with very many rows is
    never gathered in one task.
    """

    schema: StructType | str | None = None

    def __init__(self, exec: Callable[[str, pd.DataFrame], pd.DataFrame] | None = None, schema=None):
        self._exec = exec
        self.schema = schema if schema is not None else self.schema

    def exec(self, type_name: str, batch: pd.DataFrame) -> pd.DataFrame:
        if self._exec is None:
            raise NotImplementedError
        return self._exec(type_name, batch)

    def setup(self) -> None:
        """Called in the worker before the first batch of a partition."""

    def teardown(self) -> None:
        """Called in the worker after the last batch of a partition."""

    def apply(self, df: DataFrame) -> DataFrame:
        plugin = self

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            plugin.setup()
            try:
                for batch in batches:
                    for name, group in batch.groupby(TYPE, sort=False, dropna=False):
                        yield plugin.exec(name, group)
            finally:
                plugin.teardown()

        return df.mapInPandas(run, self.schema or df.schema)


class SideEffect(Plugin):
    """Runs an action on the rows, such as a write, and passes them through."""

    def __init__(self, action: Callable[[DataFrame], object]):
        self.action = action

    def apply(self, df: DataFrame) -> DataFrame:
        self.action(df)
        return df


class Observe(Plugin):
    """Named metrics of the rows flowing by, gathered by Spark's observation."""

    def __init__(self, observation, *metrics: Column):
        self.observation = observation
        self.metrics = metrics

    def apply(self, df: DataFrame) -> DataFrame:
        return df.observe(self.observation, *self.metrics)


class Compose(Plugin):
    """Left to right; no steps is the identity."""

    def __init__(self, steps: Sequence[Plugin]):
        self.steps = list(steps)

    def apply(self, df: DataFrame) -> DataFrame:
        return reduce(lambda rows, step: rows.transform(step.apply), self.steps, df)


class Branching(Plugin):
    """A step whose branches read one staged table. ``staged`` are its folders, which ``remove_staged`` removes."""

    def __init__(self) -> None:
        self.staged: list[str] = []

    def stage(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """``df`` written once, partitioned by the column ``by``; without a shuffle, so a hot branch stays spread.

        Columns of no type cannot be stored and come back as they were.
        """
        spark = df.sparkSession
        path = work_dir(spark, "branches")
        self.staged.append(path)
        untyped = [f.name for f in df.schema if isinstance(f.dataType, NullType)]
        stored = df.drop(*untyped)
        stored.write.partitionBy(*([by] if by else [])).parquet(path)
        rows = spark.read.schema(stored.schema).parquet(path)
        return rows.withColumns({name: F.lit(None) for name in untyped}).select(*[F.col(f"`{c}`") for c in df.columns])

    def remove_staged(self, df: DataFrame) -> None:
        for path in self.staged:
            remove(df.sparkSession, path)
        self.staged.clear()


class FanOut(Branching):
    """The same rows to every branch.

    One branch gives that branch's output. Several branches each run once for
    their effects, on rows that are computed once, and the input passes through.
    """

    def __init__(self, branches: Sequence[Plugin]):
        super().__init__()
        self.branches = list(branches)

    def apply(self, df: DataFrame) -> DataFrame:
        if len(self.branches) == 1:
            return self.branches[0].apply(df)
        if self.branches and not df.isStreaming:
            df = self.stage(df)
        for branch in self.branches:
            branch.apply(df)
        return df


Matcher = str | re.Pattern


_FLAGS = ((re.I, "iu"), (re.M, "m"), (re.S, "s"), (re.X, "x"))


def _java_pattern(matcher: re.Pattern) -> str:
    """The pattern with its flags, as Java reads them; what Java reads otherwise is refused."""
    if matcher.flags & (re.A | re.L) or "(?P" in matcher.pattern or "(?(" in matcher.pattern or r"\Z" in matcher.pattern:
        raise ValueError(f"pattern cannot be used in Spark: {matcher.pattern}")
    flags = "".join(letters for flag, letters in _FLAGS if matcher.flags & flag)
    # Letters, digits and blanks are Unicode's in Python.
    return f"(?U{flags})" + matcher.pattern


def _matches(kind: Column, matcher: Matcher) -> Column:
    if isinstance(matcher, re.Pattern):
        return kind.rlike(_java_pattern(matcher))
    return kind == matcher


def _row_wise(step: Plugin) -> list[ColumnPlugin] | None:
    """The column steps of a branch, or None when it is more than that."""
    if isinstance(step, ColumnPlugin):
        return [step]
    if isinstance(step, Compose):
        nested = [_row_wise(s) for s in step.steps]
        return None if None in nested else [s for steps in nested for s in steps]
    if isinstance(step, FanOut) and len(step.branches) == 1:
        return _row_wise(step.branches[0])
    return None


class Match(Branching):
    """Routes rows by their type: the first matcher that fits wins, rows without a
    match pass unchanged. A text matches exactly, a pattern anywhere in the type.
    """

    def __init__(self, routes: Sequence[tuple[Matcher, Plugin]]):
        super().__init__()
        self.routes = list(routes)

    def _route(self) -> Column:
        chosen = F.when(F.lit(False), F.lit(-1))
        for position, (matcher, _) in enumerate(self.routes):
            chosen = chosen.when(_matches(F.col(TYPE), matcher), F.lit(position))
        return chosen.otherwise(F.lit(-1))

    def apply(self, df: DataFrame) -> DataFrame:
        branches = [_row_wise(step) for _, step in self.routes]
        if None not in branches:
            return self._apply_columns(df, branches)
        return self._apply_split(df)

    def _apply_columns(self, df: DataFrame, branches: list[list[ColumnPlugin]]) -> DataFrame:
        before = {c: F.col(f"`{c}`") for c in df.columns}
        changes: dict[str, dict[int, Column]] = {}
        for position, steps in enumerate(branches):
            columns = dict(before)
            changed: dict[str, Column] = {}
            for step in steps:
                updates = step.exec(columns)
                columns.update(updates)
                changed.update(updates)
            for name, value in changed.items():
                changes.setdefault(name, {})[position] = value
        routed = df.withColumn("_route", self._route())
        new = {}
        for name, by_route in changes.items():
            value = F.when(F.lit(False), F.lit(None))
            for position, column in by_route.items():
                value = value.when(F.col("_route") == position, column)
            new[name] = value.otherwise(before[name]) if name in before else value
        return routed.withColumns(new).drop("_route")

    def _apply_split(self, df: DataFrame) -> DataFrame:
        """Rows staged by their route; a branch reads its own partition. A stream has a filtered plan per branch."""
        route = "_route"
        while route.lower() in {c.lower() for c in df.columns}:
            route += "_"
        routed = df.withColumn(route, self._route())
        if not df.isStreaming:
            routed = self.stage(routed, route)

        def rows_of(position: int) -> DataFrame:
            return routed.filter(F.col(route) == position).drop(route)

        parts = [step.apply(rows_of(i)) for i, (_, step) in enumerate(self.routes)]
        parts.append(rows_of(-1))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


class Retag(ColumnPlugin):
    """Gives messages another type."""

    def __init__(self, new_type: str | Column):
        super().__init__()
        self.new_type = new_type

    def exec(self, columns: Mapping[str, Column]) -> Mapping[str, Column]:
        return {TYPE: self.new_type if isinstance(self.new_type, Column) else F.lit(self.new_type)}


def replace_payload(df: DataFrame, **payload: Column) -> DataFrame:
    """The same types with a new payload in place of the old columns."""
    return df.select(TYPE, *[column.alias(name) for name, column in payload.items()])


def single_message(df: DataFrame, order: list[str]) -> DataFrame:
    """The first message of each type by ``order``."""
    from rillflow.operators.lookup import first_per_key

    return first_per_key(df, TYPE, order)


def as_plugin(step) -> Plugin:
    if isinstance(step, Plugin):
        return step
    if isinstance(step, type) and issubclass(step, Plugin):
        return step()
    if callable(step):
        return FunctionPlugin(step)
    raise ValueError(f"not a plugin: {step!r}")


class Pipeline(Plugin):
    """A built pipeline. ``close`` shuts its own plugins down.

    ``branching`` are the steps that stage rows. Their folders stay, as the
    output reads them, until ``remove_staged``.
    """

    def __init__(self, plugins: Mapping[str, Plugin], root: Plugin, branching: Sequence[Branching] = ()):
        self.plugins = dict(plugins)
        self.root = root
        self.branching = list(branching)

    def apply(self, df: DataFrame) -> DataFrame:
        return self.root.apply(df)

    def remove_staged(self, df: DataFrame) -> None:
        """Removes what was staged for the outputs so far; ``df`` is any DataFrame of the session."""
        for step in self.branching:
            step.remove_staged(df)

    def shutdown(self) -> None:
        for plugin in self.plugins.values():
            plugin.shutdown()

    close = shutdown


DEFAULT_DEFINITION = {"pipeline": [COMPOSE, "disk-writer"]}


def build_pipeline(definition: Mapping[str, object] | None, ctx: Context | None = None) -> Pipeline:
    """A pipeline from its definition.

    ``{"plugins": {name: plugin}, "pipeline": ["->", "a", ["match", "double", "b"], ["all", "c"]]}``.
    A name is looked up among the definition's plugins first, then in the
    context. Without a definition the rows go to the context's ``disk-writer``.
    """
    ctx = ctx or Context()
    definition = definition or DEFAULT_DEFINITION
    plugins = {name: as_plugin(step) for name, step in definition.get("plugins", {}).items()}
    for plugin in plugins.values():
        plugin.init(ctx)

    branching: list[Branching] = []

    def kept(step: Branching) -> Branching:
        branching.append(step)
        return step

    def resolve(node) -> Plugin:
        if not isinstance(node, (list, tuple)):
            found = plugins.get(node) or ctx.plugins.get(node)
            if found is None:
                raise ValueError(f"plugin not found: {node}")
            return found
        if not node:
            return Compose([])
        action, *rest = node
        if action == COMPOSE:
            return Compose([resolve(n) for n in rest])
        if action == ALL:
            return kept(FanOut([resolve(n) for n in rest]))
        if action == MATCH:
            if len(rest) % 2:
                raise ValueError("match takes pairs of matcher and step")
            return kept(Match([(rest[i], resolve(rest[i + 1])) for i in range(0, len(rest), 2)]))
        raise ValueError(f"unknown action {action!r}: a list starts with '->', 'all' or 'match'")

    return Pipeline(plugins, resolve(definition["pipeline"]), branching)
