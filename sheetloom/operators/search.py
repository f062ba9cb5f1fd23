"""Questions put to the two tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions.fields import requirement_label


def requirements_of(requirements: DataFrame, university_id: int) -> DataFrame:
    """P4."""
    return requirements.filter(F.col("university_id") == university_id)


def meets(exam: str, score: float, direction_aware: bool = False) -> Column:
    """P5: the stored minimum is at or below the score.

    ``direction_aware`` turns the comparison round for exams on which a lower
    number is the harder demand.
    """
    enough = F.col("min_score") <= score
    if direction_aware and exam in V.LOWER_IS_HARDER:
        enough = F.col("min_score") >= score
    return (F.col("exam_type") == exam) & enough


def search_by_score(
    university: DataFrame,
    requirements: DataFrame,
    exam: str,
    score: float,
    available_only: bool = False,
    direction_aware: bool = False,
) -> DataFrame:
    """Universities that accept the score, each once.

    A semi join needs no distinct; the filter reaches the requirement scan.
    """
    accepted = requirements.filter(meets(exam, score, direction_aware))
    if available_only:
        accepted = accepted.filter("is_available")
    return university.join(
        accepted.select(F.col("university_id").alias("id")), "id", "left_semi"
    )


def join_report(university: DataFrame, requirements: DataFrame) -> DataFrame:
    """University columns beside each of its requirements."""
    u = university.select(F.col("id").alias("university_id"), "name_kor", "name_eng", "nation", "language_score")
    return u.join(requirements.drop("id"), "university_id")


def nested_requirements(university: DataFrame, requirements: DataFrame) -> DataFrame:
    """Each university with its list of requirement labels, also an empty one."""
    label = requirement_label("exam_type", "min_score", "level_code")
    lists = requirements.groupBy(F.col("university_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("exam_type", label.alias("label"))))["label"].alias("labels")
    )
    return university.join(lists, "id", "left").withColumn(
        "labels", F.coalesce("labels", F.array().cast("array<string>"))
    )


def orphans(requirements: DataFrame, university: DataFrame) -> DataFrame:
    """Requirements without their university; empty when all is well."""
    return requirements.join(
        university.select(F.col("id").alias("university_id")), "university_id", "left_anti"
    )


def name_matches(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Case-insensitive any-of on a name."""
    return df.filter(F.col(column).rlike("(?iU)" + "|".join(names)))


def first_with_prefix(df: DataFrame, column: str, prefix: str, n: int = 3) -> DataFrame:
    """P12."""
    return df.filter(F.col(column).startswith(prefix)).orderBy(column).limit(n)


def top_groups(df: DataFrame, key: Column | str, n: int, name: str) -> DataFrame:
    """The n largest groups, ties by key."""
    key = F.col(key) if isinstance(key, str) else key
    return (
        df.groupBy(key.alias(name))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), name)
        .limit(n)
    )
