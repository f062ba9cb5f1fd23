"""Reading Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Session setting: a number of partitions that callers want tables dealt into, for
#: small tables in one row group.  Unset, scans are split by Spark's own settings.
PARTITIONS = "sheetloom.scan.partitions"


def read_table(spark: SparkSession, sf_dir: str, name: str, small: bool = False) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    wanted = spark.conf.get(PARTITIONS, None)
    return table.repartition(int(wanted)) if wanted and not small else table
