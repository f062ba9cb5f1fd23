"""Counts and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions.fields import field
from sheetloom.operators.merge import has_keys


def filtered_counts(university: DataFrame) -> DataFrame:
    """A1, A2/P10."""
    return university.agg(
        F.count("*").alias("n_all"),
        F.count_if(F.col("semester") == V.UNKNOWN).alias("n_unknown_semester"),
        F.count_if(F.col("min_gpa") > 0).alias("n_with_gpa"),
        F.count_if(F.col("available_majors").isNotNull()).alias("n_with_majors"),
    )


def conditional_sums(university: DataFrame) -> DataFrame:
    """A3."""
    has_remark = F.col("remark").isNotNull() & (F.col("remark") != "")
    return university.agg(
        F.sum(F.when(F.col("min_gpa") > 5, 1).otherwise(0)).alias("weird_gpa_count"),
        F.sum(F.when(has_remark, 1).otherwise(0)).alias("non_empty_remark_count"),
    )


def group_counts(df: DataFrame, key: Column | str, name: str, default: str | None = None) -> DataFrame:
    """A4: rows per key; a default stands for null keys."""
    key = F.col(key) if isinstance(key, str) else key
    if default is not None:
        key = F.coalesce(key, F.lit(default))
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("n"))


def null_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """A5: nulls and empty strings per column, in one pass, one row per column."""
    counted = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}__null") for c in columns],
        *[F.count_if(F.col(c) == "").alias(f"{c}__empty") for c in columns],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"{c}__null").alias("n_null"),
                F.col(f"{c}__empty").alias("n_empty"),
            )
            for c in columns
        ]
    )
    return counted.select(F.inline(entries))


def key_totals(listing: DataFrame) -> DataFrame:
    """Rows with all required keys, and the others."""
    return listing.agg(
        F.count_if(has_keys()).alias("valid_rows"), F.count_if(~has_keys()).alias("invalid_rows")
    )


def invalid_sample(listing: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first n rows that lack a required key."""
    return listing.filter(~has_keys()).orderBy(*order).limit(n)


def stage_counts(marked: DataFrame) -> DataFrame:
    """Rows per file that were extracted, kept in cleaning, and can be loaded, counted as they pass.

    One aggregate over the marked rows (see ``clean_marked``) that the other steps
    derive from; no stage runs again to be counted.
    """
    loaded = reduce(lambda a, b: a & b, [field(c).isNotNull() for c in V.REQUIRED_COLUMNS])
    return marked.groupBy("file").agg(
        F.count("*").alias("extracted"),
        F.count_if("kept").alias("cleaned"),
        F.count_if(F.col("kept") & loaded).alias("loaded"),
    )
