"""Metadata operations on any store Hadoop knows: list, make, move and remove. No file content passes here."""

from __future__ import annotations

from collections.abc import Iterator

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def make_folder(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.mkdirs(place)


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)


def files_below(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    """Path and length of every file below ``path``, empty ones too."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return
    found = system.listFiles(place, True)
    while found.hasNext():
        status = found.next()
        yield status.getPath().toString(), status.getLen()


def names_in(spark: SparkSession, path: str) -> list[str]:
    system, place = _place(spark, path)
    return [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []


def move(spark: SparkSession, path: str, target: str) -> None:
    """Renames one file into a folder that is there. Both paths are in one store."""
    system, place = _place(spark, path)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    if not system.rename(place, goal):
        raise OSError(f"cannot move {path} to {target}")


def move_file(spark: SparkSession, path: str, target: str) -> None:
    """Moves one file to a name of its own, by a rename or, between stores, by Hadoop's copy. A move that was done before is no error."""
    system, place = _place(spark, path)
    goal_system, goal = _place(spark, target)
    if not system.exists(place):
        if not goal_system.exists(goal):
            raise FileNotFoundError(path)
        return
    goal_system.mkdirs(goal.getParent())
    if system.getUri().equals(goal_system.getUri()):
        moved = system.rename(place, goal)
    else:
        moved = spark._jvm.org.apache.hadoop.fs.FileUtil.copy(system, place, goal_system, goal, True, True, spark._jsc.hadoopConfiguration())
    if not moved:
        raise OSError(f"cannot move {path} to {target}")


def empty_below(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    """Path and modification time (ms) of every file of zero bytes below ``path``."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return
    found = system.listFiles(place, True)
    while found.hasNext():
        status = found.next()
        if status.getLen() == 0:
            yield status.getPath().toString(), status.getModificationTime()


def footer_ok(spark: SparkSession, path: str) -> bool:
    """Whether a file ends in a Parquet footer. Raises where the store cannot be read."""
    system, place = _place(spark, path)
    if system.getFileStatus(place).getLen() == 0:
        return False
    options = spark._jvm.org.apache.parquet.HadoopReadOptions.builder(spark._jsc.hadoopConfiguration()).build()
    file = spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(place, spark._jsc.hadoopConfiguration())
    try:
        spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file, options).close()
        return True
    except Py4JJavaError as failed:
        # Parquet reports a bad footer as a runtime exception, a failing store as an IOException.
        if is_instance_of(spark.sparkContext._gateway, failed.java_exception, "java.io.IOException"):
            raise
        return False
