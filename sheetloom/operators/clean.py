"""Cleaning a listing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions import fields as X
from sheetloom.operators.grid import BLOCK_ROWS, row_block


def clean_values(listing: DataFrame, text_columns: list[str] | None = None) -> DataFrame:
    """C1-C3 on the columns the listing has."""
    names = listing.columns
    if text_columns is None:
        text_columns = [c for c in V.CANONICAL_COLUMNS + ["filename"] if c in names]
    new = {}
    for c in text_columns:
        source = X.clean_program_type(c) if c == "program_type" else F.col(c)
        value = X.collapse_whitespace(source)
        new[c] = X.normalise_gpa(value) if c == "min_gpa" else value
    return listing.withColumns(new)


def forward_fill(
    df: DataFrame,
    columns: list[str],
    file: str = "file",
    order: str = "row_idx",
    block: Column | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Fill nulls with the last value above, within a file.

    A first, small aggregate finds the last value of every row block; carried
    across blocks it gives each block a starting row.  The rows themselves are
    shuffled once, by file and block, so one very long file is many tasks.
    ``block`` must not decrease along ``order``.
    """
    block = row_block(order, block_rows) if block is None else block
    names = df.columns
    rows = df.withColumn("_block", block)

    def last_value(c: str) -> Column:
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)

    ends = rows.groupBy(file, "_block").agg(*[last_value(c) for c in columns])
    above = Window.partitionBy(file).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = ends.select(
        file, "_block", *[F.last(c, ignorenulls=True).over(above).alias(c) for c in columns]
    ).withColumn("_start", F.lit(True))
    window = (
        Window.partitionBy(file, "_block")
        .orderBy(F.col(order).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        rows.withColumn("_start", F.lit(False))
        .unionByName(starts, allowMissingColumns=True)
        .withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})
        .filter(~F.col("_start"))
        .select(*names)
    )


def has_content(df: DataFrame, columns: list[str] = ["name_kor", "nation"]) -> Column:
    """A value in any of the columns that exist."""
    existing = [F.col(c).isNotNull() for c in columns if c in df.columns]
    return reduce(lambda a, b: a | b, existing) if existing else F.lit(True)


def drop_empty_rows(df: DataFrame, columns: list[str] = ["name_kor", "nation"]) -> DataFrame:
    """Keep rows with a value in any of the columns that exist."""
    return df.filter(has_content(df, columns))


def is_listed(df: DataFrame, nan_rule: bool = False) -> Column:
    """Neither a total nor a row without a name.

    A file that has no name column at all keeps its rows, to be counted as
    skipped at load time.
    """
    keep = ~X.is_summary_row("name_kor", nan_rule)
    if "present" in df.columns:
        keep = keep | (F.col("name_kor").isNull() & ~F.array_contains("present", "name_kor"))
    return keep


def drop_summary_rows(df: DataFrame, nan_rule: bool = False) -> DataFrame:
    """Drop totals and rows without a name, as ``is_listed`` tells."""
    return df.filter(is_listed(df, nan_rule))


def clean(listing: DataFrame, nan_rule: bool = False) -> DataFrame:
    """C1, C2, C3, W1, P1 and P2 in this order."""
    return clean_marked(listing, nan_rule).filter("kept").drop("kept")


def clean_marked(listing: DataFrame, nan_rule: bool = False) -> DataFrame:
    """The same with all rows, and ``kept`` for those that stay, so that counts need no second run."""
    filled = forward_fill(clean_values(listing), V.FILLED_COLUMNS)
    kept = F.coalesce(has_content(filled) & is_listed(filled, nan_rule), F.lit(False))
    return filled.withColumn("kept", kept)


def drop_institutions(
    df: DataFrame, names: list[str] = V.EXCLUDED_INSTITUTIONS, column: str = "institution"
) -> DataFrame:
    """P8, optional: drop the listings of named institutions."""
    return df.filter(F.col(column).isNull() | ~F.col(column).isin(names))
