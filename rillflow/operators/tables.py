"""Table schemas, databases and partitions in the session catalog."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

# Partition columns of a published table.
PARTITION_COLUMNS = ("dt", "hr")

# Further tries for a failed partition statement, and the pause.
PARTITION_RETRIES = 5
RETRY_SECONDS = 2

PARTITIONS_PER_STATEMENT = 200


def lower_type(data_type: DataType) -> DataType:
    """A type with every nested field name trimmed and lower-cased."""
    if isinstance(data_type, StructType):
        return StructType([
            StructField(f.name.strip().lower(), lower_type(f.dataType), f.nullable) for f in data_type.fields
        ])
    if isinstance(data_type, ArrayType):
        return ArrayType(lower_type(data_type.elementType), data_type.containsNull)
    if isinstance(data_type, MapType):
        return MapType(lower_type(data_type.keyType), lower_type(data_type.valueType), data_type.valueContainsNull)
    return data_type


def write_schema(table_schema: StructType) -> StructType:
    """Columns a writer must supply: lower-cased, without the partition columns."""
    lowered = lower_type(table_schema)
    return StructType([f for f in lowered.fields if f.name not in PARTITION_COLUMNS])


def table_write_schema(spark: SparkSession, table: str) -> StructType:
    return write_schema(spark.table(table).schema)


def described_columns(spark: SparkSession, table: str) -> DataFrame:
    """``col_name, data_type`` of a table's data columns."""
    rows = spark.sql(f"DESCRIBE TABLE {table}").filter(F.col("data_type").isNotNull() & ~F.col("col_name").startswith("#"))
    name = F.lower(F.trim("col_name"))
    return (
        rows.select(name.alias("col_name"), F.lower(F.trim("data_type")).alias("data_type"))
        .filter((F.col("col_name") != "") & (F.col("data_type") != "") & ~F.col("col_name").isin(*PARTITION_COLUMNS))
        .distinct()
    )


def conform_value(value: Column, have: DataType, want: DataType) -> Column:
    """A value in another type. Fields of nested structs are matched by lower-cased name, absent ones are NULL.

    Text becomes a nested value by its JSON; any other value that cannot become one is NULL.
    """
    if isinstance(want, StructType) and isinstance(have, StructType):
        source = {f.name.strip().lower(): f for f in have.fields}
        fields = [
            (conform_value(value.getField(source[f.name].name), source[f.name].dataType, f.dataType) if f.name in source else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return F.transform(value, lambda v: conform_value(v, have.elementType, want.elementType))
    if isinstance(want, MapType) and isinstance(have, MapType):
        return F.transform_values(value, lambda _, v: conform_value(v, have.valueType, want.valueType)).try_cast(want)
    if isinstance(want, (StructType, ArrayType, MapType)):
        return F.from_json(value, want) if isinstance(have, StringType) else F.lit(None).cast(want)
    return value.try_cast(want)


def conform_columns(df: DataFrame, schema: StructType) -> list[Column]:
    source = {f.name.strip().lower(): f for f in df.schema.fields}
    return [
        (conform_value(F.col(f"`{source[f.name].name}`"), source[f.name].dataType, f.dataType) if f.name in source else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]


def schema_groups(schemas: Mapping[str, StructType]) -> dict[str, tuple[StructType, list[str]]]:
    """Topics by the fingerprint of their schema, with that schema. The order of columns does not count."""
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for topic, schema in sorted(schemas.items()):
        ordered = StructType(sorted(schema.fields, key=lambda f: f.name))
        fingerprint = hashlib.md5(ordered.simpleString().encode()).hexdigest()
        groups.setdefault(fingerprint, (ordered, []))[1].append(topic)
    return groups


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns matched by lower-cased name and cast; absent ones become NULL.

    Matching is by name because a described schema gives no dependable order.
    """
    return df.select(*conform_columns(df, schema))


def schemas_by_topic(catalog: DataFrame, known: dict[str, StructType] | None = None) -> dict[str, StructType]:
    """Write schema of every topic whose output is not JSON and that has none yet.

    A topic whose table cannot be described is left out and tried again at the
    next refresh.
    """
    spark = catalog.sparkSession
    result = dict(known or {})
    wanted = catalog.filter(
        (F.coalesce(F.col("output_format"), F.lit("")) != "json") & F.col("hive_table_name").isNotNull()
    )
    for row in wanted.select("log", "hive_table_name").toLocalIterator():
        if row["log"] not in result and spark.catalog.tableExists(row["hive_table_name"]):
            schema = table_write_schema(spark, row["hive_table_name"])
            if schema.fields:
                result[row["log"]] = schema
    return result


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def create_landing_table(spark: SparkSession, table: str, columns: str = "tname string", using: str = "parquet") -> None:
    """A table partitioned by day and hour; its files are placed by the publisher."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, dt string, hr string) USING {using} PARTITIONED BY (dt, hr)")


def add_partitions(spark: SparkSession, table: str, partitions: Iterable[tuple[str, str, str]], retries: int = PARTITION_RETRIES, pause: float = RETRY_SECONDS) -> str | None:
    """Register ``(dt, hr, location)`` partitions, many in a statement; the error that stopped it, or None.

    The directories say ``date=``/``hour=`` and the table says ``dt``/``hr``, so
    the location is always given. What analysis refuses, such as a missing
    table, is not tried again; other failures are.
    """
    wanted = list(partitions)
    for first in range(0, len(wanted), PARTITIONS_PER_STATEMENT):
        specs = " ".join(f"PARTITION (dt='{dt}', hr='{hr}') LOCATION '{place}'" for dt, hr, place in wanted[first:first + PARTITIONS_PER_STATEMENT])
        failure = _tried(spark, f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}", retries, pause)
        if failure:
            return failure
    return None


def set_locations(spark: SparkSession, table: str, partitions: Iterable[tuple[str, str, str]], retries: int = PARTITION_RETRIES, pause: float = RETRY_SECONDS) -> str | None:
    """Switch ``(dt, hr, location)`` partitions that lie elsewhere, one statement each; the error that stopped it, or None."""
    for dt, hr, place in partitions:
        spec = f"PARTITION (dt='{dt}', hr='{hr}')"
        try:
            told = spark.sql(f"DESCRIBE FORMATTED {table} {spec}").where("col_name = 'Location'").first()
        except AnalysisException as refused:
            return str(refused)
        if told and told["data_type"].rstrip("/") == place.rstrip("/"):
            continue
        failure = _tried(spark, f"ALTER TABLE {table} {spec} SET LOCATION '{place}'", retries, pause)
        if failure:
            return failure
    return None


def _tried(spark: SparkSession, statement: str, retries: int, pause: float) -> str | None:
    for attempt in range(retries + 1):
        try:
            spark.sql(statement)
            return None
        except AnalysisException as refused:
            return str(refused)
        except Exception as failed:
            if attempt == retries:
                return str(failed)
            time.sleep(pause)
