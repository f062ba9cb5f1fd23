"""Writing results: CSV export and table snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from sheetloom.session import exists


def write_csv(df: DataFrame, path: str) -> None:
    """With header, UTF-8, blanks as they are; an empty text is quoted, a null is not.

    Spark writes no byte-order mark.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def csv_line(values: Column) -> Column:
    """An array of texts as one CSV line; nulls are nothing, empty texts and those with marks or blanks are quoted."""

    def cell(v: Column) -> Column:
        quoted = F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(v.isNull(), "").when(v.rlike(r'^$|[",\s]'), quoted).otherwise(v)

    return F.array_join(F.transform(values, cell), ",")


def write_lines(lines: DataFrame, path: str) -> None:
    """``file, row_idx, line`` as a folder of text for each file, its parts in the order of rows."""
    (
        lines.repartitionByRange("file", "row_idx")
        .sortWithinPartitions("file", "row_idx")
        .select("file", "line")
        .write.mode("overwrite")
        .partitionBy("file")
        .text(path)
    )


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Reads back what ``write_csv`` wrote: nothing is null, quoted nothing an empty text."""
    return (
        spark.read.option("header", True)
        .option("nullValue", "\0")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("multiLine", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .schema(schema)
        .csv(path)
    )


def write_tables(
    university: DataFrame, derive: Callable[[DataFrame], DataFrame], path: str
) -> tuple[DataFrame, DataFrame]:
    """Write the entities, derive their requirements from them, write those.

    Both make a new snapshot; its marker is written last, so that readers see both
    tables of one load or of the load before.  Requirements are range-partitioned and
    sorted by exam and score, so that a score search reads only the row groups of its
    exam; filters on the universities' ids let a lookup by id skip the row groups that
    don't have it (P4, J7).
    """
    spark = university.sparkSession
    number = (_last_snapshot(spark, path) or 0) + 1
    folder = f"{path}/snapshot-{number}"
    _indexed(university.write.mode("overwrite"), "id").parquet(f"{folder}/university")
    requirements = (
        derive(spark.read.parquet(f"{folder}/university"))
        .repartitionByRange("exam_type", "min_score", "university_id")
        .sortWithinPartitions("exam_type", "min_score")
    )
    _indexed(requirements.write.mode("overwrite"), "university_id").parquet(f"{folder}/language_requirement")
    spark.range(1).write.mode("overwrite").parquet(f"{path}/snapshots/number={number}")
    return read_tables(spark, path)


def _indexed(writer: DataFrameWriter, column: str) -> DataFrameWriter:
    """Parquet bloom filters on a column, of a size that follows from each row group's values."""
    return writer.option(f"parquet.bloom.filter.enabled#{column}", True).option("parquet.bloom.filter.adaptive.enabled", True)


def _last_snapshot(spark: SparkSession, path: str) -> int | None:
    if not exists(spark, f"{path}/snapshots"):
        return None
    return spark.read.schema("id long, number int").parquet(f"{path}/snapshots").agg(F.max("number")).first()[0]


def read_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Both tables of the last whole snapshot."""
    number = _last_snapshot(spark, path)
    if number is None:
        raise FileNotFoundError(f"no tables in {path}")
    folder = f"{path}/snapshot-{number}"
    return (
        spark.read.parquet(f"{folder}/university"),
        spark.read.parquet(f"{folder}/language_requirement"),
    )
