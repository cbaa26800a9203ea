"""Registered queries: each runs library operators over whole tables, with the
same result stated in SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from rillflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    run: Query
    sql: str | None


class Registry(dict):
    """Name to query; ``add`` is a decorator that takes the equivalent SQL."""

    def add(self, sql: str | None = None):
        def register(run: Query) -> Query:
            def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
                return run(configure(spark), sf_dir)

            self[run.__name__] = Registered(configured, sql)
            return run

        return register


def all_queries() -> dict[str, Registered]:
    merged: dict[str, Registered] = {}
    for name in ("text", "keys", "catalog", "quality", "routing", "metrics", "landing", "streams"):
        merged.update(import_module(f"rillflow.queries.{name}").QUERIES)
    return merged
