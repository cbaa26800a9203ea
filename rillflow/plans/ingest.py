"""Ingest: raw messages to parsed rows, through the pipeline, to landed files."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow.operators.parse import parse_messages
from rillflow.operators.quality import split_by_error, with_hour_key
from rillflow.plans.pipelines import TYPE, Context, Plugin, build_pipeline
from rillflow.session import work_dir
from rillflow.sinks.landing import land_by_codec


@dataclass
class IngestPlan:
    """What an ingest run needs besides its messages.

    ``definition`` is a pipeline definition; the default lands every message.
    ``run`` names the run: running it again replaces its own files and no others.
    Without a name a plan is a run of its own.
    """

    landing: str
    definition: Mapping[str, object] | None = None
    plugins: dict = field(default_factory=dict)
    conf: Mapping[str, object] = field(default_factory=dict)
    avro_schemas: Mapping[str, str] | None = None
    parquet_schema: StructType | None = None
    schemas: Mapping[str, StructType] | None = None
    writers: int | None = None
    run: str = field(default_factory=lambda: uuid.uuid4().hex)
    batch: str = "0"
    mode: str = "overwrite"


def parsed_rows(messages: DataFrame, catalog: DataFrame, avro_schemas: Mapping[str, str] | None = None) -> DataFrame:
    """Parsed messages with their hour, typed by topic for the pipeline."""
    return with_hour_key(parse_messages(messages, catalog, avro_schemas)).withColumn(TYPE, F.col("topic"))


class DiskWriter(Plugin):
    """The built-in plugin that lands its rows. Rows that no sink takes are kept as ``rejected``."""

    def __init__(self, plan: IngestPlan):
        self.plan = plan
        self.rejected: list[DataFrame] = []

    def apply(self, df: DataFrame) -> DataFrame:
        plan = self.plan
        self.rejected.append(land_by_codec(df, plan.landing, plan.parquet_schema, plan.run, plan.batch, plan.mode, plan.writers, plan.schemas))
        return df


class IngestPipeline:
    """The plan's pipeline, built once with its plugins started.

    The caller closes it after the rows of its output have run: plugins are
    needed until then.
    """

    def __init__(self, plan: IngestPlan):
        self.writer = DiskWriter(plan)
        self.pipeline = build_pipeline(plan.definition, Context(plan.conf, {"disk-writer": self.writer, **plan.plugins}))

    def apply(self, good: DataFrame, plan: IngestPlan | None = None) -> tuple[DataFrame, list[DataFrame]]:
        """The pipeline's output, and the rows that its disk writer could not land."""
        self.writer.plan = plan or self.writer.plan
        self.writer.rejected = []
        return self.pipeline.apply(good), self.writer.rejected

    def remove_staged(self, df: DataFrame) -> None:
        self.pipeline.remove_staged(df)

    def close(self) -> None:
        self.pipeline.close()


def with_rejected(bad: DataFrame, rejected: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rejected, bad)


def run_ingest(messages: DataFrame, catalog: DataFrame, plan: IngestPlan) -> DataFrame:
    """Parse, run the pipeline on the good rows, return the bad ones.

    Messages are parsed once, into a staged table that everything after reads,
    so the raw input is scanned once whatever the codecs. The caller
    quarantines and counts what is returned. That table, and what branches of the
    pipeline stage, stay below ``spark.checkpoint.dir``, as the result reads them.
    """
    spark = messages.sparkSession
    staged = work_dir(spark, "parsed")
    parsed = parsed_rows(messages, catalog, plan.avro_schemas)
    parsed.write.parquet(staged)
    split = split_by_error(spark.read.schema(parsed.schema).parquet(staged))
    pipeline = IngestPipeline(plan)
    try:
        _, rejected = pipeline.apply(split.good)
        return with_rejected(split.bad, rejected)
    finally:
        pipeline.close()
