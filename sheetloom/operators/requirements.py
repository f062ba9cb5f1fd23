"""Requirement extraction as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.functions import requirements as R
from sheetloom.functions.text import as_column, blank_to_null


def with_open_text(df: DataFrame, text: Column | str, waiver_mode: str = "legacy") -> DataFrame:
    """Adds ``_text`` and upper-cased ``_upper``, null where nothing is asked.

    A column instead of a filter: a filter on a computed text would be pushed
    down to the scan together with a second copy of the computation.
    """
    return (
        df.withColumn("_text", blank_to_null(text))
        .withColumn("_upper", F.upper("_text"))
        .withColumn("_upper", F.when(~R.is_waived("_upper", waiver_mode), F.col("_upper")))
        .withColumn("_text", F.when(F.col("_upper").isNotNull(), F.col("_text")))
    )


def with_requirements(
    df: DataFrame,
    text: Column | str = "language_requirement",
    region: Column | str = "region",
    waiver_mode: str = "legacy",
    name: str = "requirements",
) -> DataFrame:
    """X1 without the explode: one array of scored exams per row.

    The steps are separate projections because later ones use earlier ones
    several times; Catalyst keeps such projections apart.
    """
    keep = df.columns
    staged = (
        with_open_text(df.withColumn("_region", as_column(region)), text, waiver_mode)
        .withColumns(
            {
                "_excluded": R.text_exclusions("_upper"),
                "_rows": R.code_rows(R.grade_codes("_upper", "_region")),
                "_hits": R.direct_hits("_text", "_upper"),
            }
        )
        .withColumns(
            {
                "_evidence": R.exam_evidence("_rows", "_hits", "_excluded"),
                "_english": R.english_code("_rows"),
            }
        )
    )
    return staged.select(*keep, R.merge_scores("_evidence", "_english").alias(name))


def extract_requirements(
    df: DataFrame,
    text: Column | str = "language_requirement",
    region: Column | str = "region",
    keep: list[str] | None = None,
    waiver_mode: str = "legacy",
) -> DataFrame:
    """One output row per scored exam of each input row."""
    keep = df.columns if keep is None else keep
    parsed = with_requirements(df, text, region, waiver_mode, "_requirements")
    return inline_requirements(parsed, keep, "_requirements")


def inline_requirements(df: DataFrame, keep: list[str], name: str = "requirements") -> DataFrame:
    """One row per array entry.

    The outer form plus a filter, because for the inner form Catalyst infers
    ``size(array) > 0`` and pushes it, with the whole extraction written out
    again, down to the scan.
    """
    return df.select(*keep, F.inline_outer(name)).filter(F.col("exam_type").isNotNull())


def expand_codes(df: DataFrame, standards: DataFrame, codes: str = "codes") -> DataFrame:
    """Explode codes and join the minimums of a standards table.

    The table may be of any size: Spark broadcasts it when its measured size
    is below the session's threshold and shuffles otherwise.
    """
    others = [c for c in df.columns if c != codes]
    exploded = df.select(*others, F.explode_outer(codes).alias("code"))
    return exploded.filter(F.col("code").isNotNull()).join(standards, "code")


def mark_available(requirements: DataFrame, excluded: Column | str) -> DataFrame:
    """False where a note rules the exam out; the row itself stays."""
    return requirements.withColumn(
        "is_available",
        ~F.coalesce(F.array_contains(as_column(excluded), F.col("exam_type")), F.lit(False)),
    )
