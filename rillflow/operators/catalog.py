"""The topic catalog: one row per topic with its format and destinations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from rillflow.functions.keys import jdbc_database, table_name
from rillflow.functions.values import value_or
from rillflow.operators.lookup import lookup_join

# Catalog columns.
CATALOG_SCHEMA = StructType(
    [
        StructField("log", StringType(), False),
        StructField("format", StringType()),
        StructField("output_format", StringType()),
        StructField("base_partition", StringType()),
        StructField("log_partition", StringType()),
        StructField("hive_table_name", StringType()),
        StructField("hive_url", StringType()),
        StructField("hive_user", StringType()),
        StructField("hive_password", StringType()),
        StructField("quarantine", StringType()),
        StructField("date_format", StringType()),
        StructField("log_group", StringType()),
        StructField("enabled", IntegerType()),
    ]
)

# Column defaults of the catalog, where a default exists besides
# the quarantine folder.
DEFAULT_DATE_FORMAT = "datehour"
DEFAULT_GROUP = "default"
DEFAULT_ENABLED = 1

# Output formats written with a codec of the same name or none;
# every other output format is gzip text.
CODEC_OF_OUTPUT_FORMAT = {"parquet": "parquet", "txt": "none", "snappy": "snappy", "bzip2": "bzip2"}
DEFAULT_CODEC = "gzip"
DEFAULT_OUTPUT_FORMAT = "txt"


@dataclass(frozen=True)
class PublishDefaults:
    """Destinations of a topic the catalog does not know."""

    base_partition: str = "/log/rillflow"
    quarantine: str = "/tmp/rillflow-quarantine"
    database: str = "rillflow"
    user: str = "hive"
    password: str = ""
    date_format: str = DEFAULT_DATE_FORMAT


def make_catalog(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A catalog from plain rows; absent columns take the catalog defaults."""
    defaults = {
        "quarantine": PublishDefaults().quarantine,
        "date_format": DEFAULT_DATE_FORMAT,
        "log_group": DEFAULT_GROUP,
        "enabled": DEFAULT_ENABLED,
    }
    full = [{**dict.fromkeys(CATALOG_SCHEMA.names), **defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(r[n] for n in CATALOG_SCHEMA.names) for r in full], CATALOG_SCHEMA)


def read_catalog_jdbc(spark: SparkSession, url: str, table: str = "topic_catalog", **options: str) -> DataFrame:
    """The catalog in a SQL database. Filters on it are pushed to the database."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_catalog_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def topic_row(catalog: DataFrame, topic: str) -> DataFrame:
    """The catalog row of one topic."""
    return catalog.filter(F.col("log") == topic).limit(1)


def save_catalog(catalog: DataFrame, path: str, snapshot: int) -> None:
    """Store a catalog as the given snapshot. Earlier snapshots stay readable, so
    a job may write a catalog it is still reading."""
    catalog.coalesce(1).write.mode("overwrite").parquet(f"{path}/snapshot={snapshot}")


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The newest stored snapshot."""
    stored = spark.read.schema(StructType([*CATALOG_SCHEMA.fields, StructField("snapshot", IntegerType())])).parquet(path)
    newest = stored.agg(F.max("snapshot")).first()[0]
    return stored.filter(F.col("snapshot") == newest).drop("snapshot")


def enabled_topics(catalog: DataFrame, group: str) -> DataFrame:
    return catalog.filter((F.col("log_group") == group) & (F.col("enabled") == 1)).select("log")


def topics_to_start(enabled: DataFrame, active: DataFrame) -> DataFrame:
    """Enabled topics that are not active yet."""
    return enabled.subtract(active)


def topics_to_stop(enabled: DataFrame, active: DataFrame) -> DataFrame:
    """Active topics that are no longer enabled."""
    return active.subtract(enabled)


def disable_topics(catalog: DataFrame, topics: DataFrame) -> DataFrame:
    """The catalog with ``enabled = 0`` for the given ``topic`` rows."""
    flags = topics.select("topic").distinct().withColumn("_off", F.lit(True))
    marked = lookup_join(catalog, flags, "log", "topic")
    enabled = F.when(F.col("_off"), F.lit(0)).otherwise(F.col("enabled"))
    return marked.withColumn("enabled", enabled).drop("_off")


def output_format_or_default(output_format: Column) -> Column:
    return F.coalesce(F.lower(output_format), F.lit(DEFAULT_OUTPUT_FORMAT))


def codec_for(output_format: Column) -> Column:
    """Codec of an output format that went through ``output_format_or_default``."""
    codec = F.when(F.lit(False), F.lit(DEFAULT_CODEC))
    for name, value in CODEC_OF_OUTPUT_FORMAT.items():
        codec = codec.when(output_format == name, F.lit(value))
    return codec.otherwise(F.lit(DEFAULT_CODEC))


def with_publish_settings(
    rows: DataFrame, catalog: DataFrame, topic: str = "topic", defaults: PublishDefaults = PublishDefaults()
) -> DataFrame:
    """Destination settings per row.

    A topic with a row keeps its columns, except that a missing database or table
    name is filled in, the table with the topic itself. A topic without a row
    takes every default; its table name has ``-`` replaced by ``_``.
    """
    side = catalog.select(
        "log",
        F.lit(True).alias("_known"),
        "base_partition",
        "log_partition",
        value_or(jdbc_database(F.col("hive_url")), defaults.database).alias("hive_db_name"),
        value_or(F.col("hive_table_name"), F.col("log")).alias("hive_table_name"),
        "date_format",
        "quarantine",
        "hive_url",
        "hive_user",
        "hive_password",
    )
    name = F.col(topic)
    fallback = {
        "base_partition": F.lit(defaults.base_partition),
        "log_partition": name,
        "hive_db_name": F.lit(defaults.database),
        "hive_table_name": table_name(name),
        "date_format": F.lit(defaults.date_format),
        "quarantine": F.lit(defaults.quarantine),
        "hive_user": F.lit(defaults.user),
        "hive_password": F.lit(defaults.password),
    }
    joined = lookup_join(rows, side, topic, "log")
    filled = {c: F.when(F.col("_known"), F.col(c)).otherwise(v) for c, v in fallback.items()}
    return joined.withColumns(filled).drop("_known")
