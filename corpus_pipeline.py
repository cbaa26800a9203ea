"""From raw documents to packed training sequences, in five stages.

Every stage takes what the one before it kept, written as Parquet and read
again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import decontaminate, language, near_dup, packing, secrets
from rillflow.llm.queries import tokenizer_path
from rillflow.llm.shared import stage, table


#: Bytes of a batch that goes to a Python worker. Whole rows pass through the stages' workers, in and out of both
#: processes, so this, and not the number of rows, must bound them; one longer text is a batch alone.
BATCH_BYTES = 1 << 20

#: Rows of a batch that a Parquet scan decodes: the texts of a batch lie in one array on the heap.
SCAN_ROWS = 512

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(work: Stage) -> Stage:
    """The settings stay with the session, as the stage's rows are only computed when they are written."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))
        return work(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Names each document's language; those without letters, or unlike every language for their length, go.

    Labels of a third of the documents are not learned from, as in the query.
    """
    model = language.learn(docs.where(~language.held_out()))
    named = language.predict(docs, model)
    accepted = (F.col("_lang") != language.UNKNOWN) & (F.col("_score") >= language.LEAST_SCORE)
    return named.where(accepted).withColumn("lang", F.col("_lang")).select(*docs.columns)


@in_small_batches
def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, that of the smallest id; rows without words all stay."""
    return near_dup.one_of_each(docs)


@in_small_batches
def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth or more go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redacted(docs)


@in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in windows of 1024 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), 0, batch_bytes=BATCH_BYTES, pieces=100_000)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name)
    return docs


#: Tokenizing and the vectors of letters cannot be stated in SQL; tests/llm runs the stages one by one.
ORACLE_SQL = None
