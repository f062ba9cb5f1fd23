"""Intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from sheetloom.session import run_dir

_collecting: list[list[str]] = []


def stage(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """Write a step that later steps read several times, and read it back.

    Besides saving the repeated work this gives Spark the real size of the
    step, so a lookup is broadcast only when its files are below the session's
    threshold.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    for folders in _collecting:
        folders.append(path)
    df.write.partitionBy(*partitions).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def collected() -> Iterator[list[str]]:
    """The folders of all tables that are staged meanwhile, to be released once nothing reads them."""
    folders: list[str] = []
    _collecting.append(folders)
    try:
        yield folders
    finally:
        _collecting[:] = [f for f in _collecting if f is not folders]


def release(spark: SparkSession, folders: Iterable[str]) -> None:
    """Deletes staged tables."""
    for folder in folders:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
