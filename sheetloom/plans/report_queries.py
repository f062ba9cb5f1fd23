"""Counts, audits, lookups and reports over the two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions import fields as X
from sheetloom.operators import merge as M
from sheetloom.operators import reports as A
from sheetloom.operators import search as S
from sheetloom.plans import checks as C
from sheetloom.plans.merge_checks import VALID
from sheetloom.plans.merge_queries import ENTITIES, valid_entities
from sheetloom.plans.registry import query

# Reports run over every valid listing row as a university of its own, with the
# row number as id: the largest tables the inputs give.
TABLES = f"""WITH {ENTITIES}, university AS (SELECT * EXCLUDE (file, row_idx), row_idx AS id FROM entities WHERE {VALID}),
    {C.requirement_ctes('SELECT id, language_score AS text, region FROM university')},
    {C.exclusion_ctes('SELECT id, significant_note AS note FROM university')},
    exams AS {C.values([(i + 1, e) for i, (e, _) in enumerate(V.EXAM_GROUPS)], 'pos, exam')},
    requirement AS (SELECT CAST(r.id * 100 + e.pos AS BIGINT) AS id, r.id AS university_id, r.language_group, r.exam_type, r.min_score,
            r.level_code, b.exam IS NULL AS is_available
        FROM req r JOIN exams e ON e.exam = r.exam_type LEFT JOIN banned b ON b.id = r.id AND b.exam = r.exam_type)"""


def _university(spark: SparkSession, sf: str) -> DataFrame:
    return valid_entities(spark, sf).withColumnRenamed("row_idx", "id")


def _requirement(spark: SparkSession, sf: str) -> DataFrame:
    return M.requirement_table(_university(spark, sf))


@query(
    "count_filtered",
    f"""{TABLES} SELECT count(*) AS n_all, count(*) FILTER (WHERE semester = 'Unknown') AS n_unknown_semester,
        count(*) FILTER (WHERE min_gpa > 0) AS n_with_gpa, count(available_majors) AS n_with_majors FROM university""",
)
def count_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return A.filtered_counts(_university(spark, sf))


@query(
    "conditional_sums",
    f"""{TABLES} SELECT CAST(SUM(CASE WHEN min_gpa > 5.0 THEN 1 ELSE 0 END) AS BIGINT) AS weird_gpa_count,
        CAST(SUM(CASE WHEN remark IS NOT NULL AND remark != '' THEN 1 ELSE 0 END) AS BIGINT) AS non_empty_remark_count FROM university""",
)
def conditional_sums(spark: SparkSession, sf: str) -> DataFrame:
    return A.conditional_sums(_university(spark, sf))


@query("group_by_region", f"{TABLES} SELECT region, count(*) AS n FROM university GROUP BY region")
def group_by_region(spark: SparkSession, sf: str) -> DataFrame:
    return A.group_counts(_university(spark, sf), "region", "region")


@query("group_by_nation", f"{TABLES} SELECT nation, count(*) AS n FROM university GROUP BY nation")
def group_by_nation(spark: SparkSession, sf: str) -> DataFrame:
    return A.group_counts(_university(spark, sf), "nation", "nation")


@query("group_by_exam", f"{TABLES} SELECT exam_type, count(*) AS n FROM requirement GROUP BY exam_type")
def group_by_exam(spark: SparkSession, sf: str) -> DataFrame:
    return A.group_counts(_requirement(spark, sf), "exam_type", "exam_type")


@query(
    "group_by_level",
    f"{TABLES} SELECT coalesce(level_code, '{V.DIRECT_LABEL}') AS level_code, count(*) AS n FROM requirement GROUP BY 1",
)
def group_by_level(spark: SparkSession, sf: str) -> DataFrame:
    return A.group_counts(_requirement(spark, sf), "level_code", "level_code", V.DIRECT_LABEL)


@query("top_regions", f"{TABLES} SELECT region, count(*) AS n FROM university GROUP BY region ORDER BY n DESC, region LIMIT 6")
def top_regions(spark: SparkSession, sf: str) -> DataFrame:
    return S.top_groups(_university(spark, sf), "region", 6, "region")


@query("top_nations", f"{TABLES} SELECT nation, count(*) AS n FROM university GROUP BY nation ORDER BY n DESC, nation LIMIT 5")
def top_nations(spark: SparkSession, sf: str) -> DataFrame:
    return S.top_groups(_university(spark, sf), "nation", 5, "nation")


@query(
    "top_levels",
    f"""{TABLES} SELECT coalesce(level_code, '{V.DIRECT_LABEL}') AS level_code, count(*) AS n FROM requirement
        GROUP BY 1 ORDER BY n DESC, level_code LIMIT 10""",
)
def top_levels(spark: SparkSession, sf: str) -> DataFrame:
    key = F.coalesce("level_code", F.lit(V.DIRECT_LABEL))
    return S.top_groups(_requirement(spark, sf), key, 10, "level_code")


_AUDITED = ["region", "semester", "significant_note", "remark", "available_majors", "website_url", "badge", "language_score"]


@query(
    "null_audit",
    TABLES
    + " UNION ALL ".join(
        f" SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(*) FILTER (WHERE {c} = '') AS n_empty FROM university"
        for c in _AUDITED
    ),
)
def null_audit(spark: SparkSession, sf: str) -> DataFrame:
    return A.null_audit(_university(spark, sf), _AUDITED)


@query("count_all", f"{TABLES} SELECT count(*) AS n FROM university")
def count_all(spark: SparkSession, sf: str) -> DataFrame:
    return _university(spark, sf).agg(F.count("*").alias("n"))


@query("distinct_names", f"{TABLES} SELECT DISTINCT name_eng FROM university")
def distinct_names(spark: SparkSession, sf: str) -> DataFrame:
    return _university(spark, sf).select("name_eng").distinct()


@query("distinct_badges", f"{TABLES} SELECT DISTINCT badge FROM university WHERE badge IS NOT NULL")
def distinct_badges(spark: SparkSession, sf: str) -> DataFrame:
    return _university(spark, sf).select("badge").dropna().distinct()


@query(
    "join_report",
    f"""{TABLES} SELECT u.name_kor, u.language_score, r.exam_type, r.min_score, r.level_code
        FROM university u JOIN requirement r ON u.id = r.university_id WHERE r.exam_type = 'DELE'""",
)
def join_report(spark: SparkSession, sf: str) -> DataFrame:
    report = S.join_report(_university(spark, sf), _requirement(spark, sf).filter("exam_type = 'DELE'"))
    return report.select("name_kor", "language_score", "exam_type", "min_score", "level_code")


@query(
    "nested_requirements",
    f"""{TABLES}, labelled AS (SELECT university_id, exam_type, exam_type || ' ' ||
            CASE WHEN min_score = floor(min_score) THEN CAST(CAST(min_score AS BIGINT) AS STRING) ELSE CAST(min_score AS STRING) END
            || CASE WHEN coalesce(level_code, '') <> '' THEN ' (' || level_code || ')' ELSE '' END AS label FROM requirement)
        SELECT u.id, u.name_eng, coalesce(string_agg(l.label, '; ' ORDER BY l.exam_type), '') AS labels
        FROM university u LEFT JOIN labelled l ON l.university_id = u.id GROUP BY u.id, u.name_eng""",
)
def nested_requirements(spark: SparkSession, sf: str) -> DataFrame:
    nested = S.nested_requirements(_university(spark, sf), _requirement(spark, sf))
    return nested.select("id", "name_eng", F.array_join("labels", "; ").alias("labels"))


@query(
    "labels",
    f"""{TABLES} SELECT id, concat_ws(' ', exam_type,
            CASE WHEN min_score = floor(min_score) THEN CAST(CAST(min_score AS BIGINT) AS STRING) ELSE CAST(min_score AS STRING) END,
            '(' || nullif(level_code, '') || ')') AS label FROM requirement""",
)
def labels(spark: SparkSession, sf: str) -> DataFrame:
    label = X.requirement_label("exam_type", "min_score", "level_code")
    return _requirement(spark, sf).select("id", label.alias("label"))


@query(
    "display_rows",
    f"""{TABLES} SELECT id, 'GPA: ' || CASE WHEN min_gpa <> 0 THEN CAST(min_gpa AS STRING) ELSE 'N/A' END AS gpa,
        concat_ws(', ', CASE WHEN is_exchange THEN 'Exchange' END, CASE WHEN is_visit THEN 'Visiting' END) AS programs,
        coalesce(left(available_majors, 30), 'None') || '...' AS majors FROM university""",
)
def display_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _university(spark, sf).select(
        "id",
        X.display_gpa("min_gpa").alias("gpa"),
        X.display_programs("is_exchange", "is_visit").alias("programs"),
        X.display_text("available_majors").alias("majors"),
    )


_LIKE = """name_eng LIKE '%#00000001%' OR name_eng LIKE '%77' OR name_eng LIKE 'Customer%9_9'
    OR remark IS NOT NULL AND remark != ''"""


@query("like_filter", f"{TABLES} SELECT name_eng, min_gpa, remark FROM university WHERE {_LIKE}")
def like_filter(spark: SparkSession, sf: str) -> DataFrame:
    names = F.col("name_eng")
    named = names.like("%#00000001%") | names.like("%77") | names.like("Customer%9_9")
    remarked = F.col("remark").isNotNull() & (F.col("remark") != "")
    return _university(spark, sf).filter(named | remarked).select("name_eng", "min_gpa", "remark")


@query(
    "sql_report",
    f"{TABLES} SELECT id, name_eng, min_gpa, remark FROM university WHERE {_LIKE} ORDER BY id LIMIT 10",
)
def sql_report(spark: SparkSession, sf: str) -> DataFrame:
    """A report written as SQL text, as callers do."""
    return spark.sql(
        f"SELECT id, name_eng, min_gpa, remark FROM {{university}} WHERE {_LIKE} ORDER BY id LIMIT 10",
        university=_university(spark, sf),
    )


@query("prefix_first", f"{TABLES} SELECT DISTINCT name_eng FROM university WHERE name_eng LIKE 'Customer#0000000%' ORDER BY name_eng LIMIT 3")
def prefix_first(spark: SparkSession, sf: str) -> DataFrame:
    names = _university(spark, sf).select("name_eng").distinct()
    return S.first_with_prefix(names, "name_eng", "Customer#0000000")


@query("ordered_first", f"{TABLES} SELECT id, name_kor, nation FROM university ORDER BY name_kor, id LIMIT 20")
def ordered_first(spark: SparkSession, sf: str) -> DataFrame:
    return _university(spark, sf).select("id", "name_kor", "nation").orderBy("name_kor", "id").limit(20)


@query("sample_first", f"{TABLES} SELECT id, name_kor, nation, has_review FROM university ORDER BY id LIMIT 5")
def sample_first(spark: SparkSession, sf: str) -> DataFrame:
    return _university(spark, sf).select("id", "name_kor", "nation", "has_review").orderBy("id").limit(5)


@query("universities_ordered", f"{TABLES} SELECT id, name_kor, semester FROM university ORDER BY name_kor")
def universities_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return _university(spark, sf).select("id", "name_kor", "semester").orderBy("name_kor")


@query("requirements_ordered", f"{TABLES} SELECT * FROM requirement ORDER BY university_id, exam_type")
def requirements_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return _requirement(spark, sf).orderBy("university_id", "exam_type")


@query("point_lookup", f"{TABLES} SELECT * FROM requirement WHERE university_id = (SELECT min(university_id) FROM requirement WHERE exam_type = 'JLPT')")
def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    requirements = _requirement(spark, sf)
    first = requirements.filter("exam_type = 'JLPT'").agg(F.min("university_id")).first()[0]
    return S.requirements_of(requirements, first)


@query(
    "listing_search",
    f"""{TABLES} SELECT id, name_eng, nation FROM university u WHERE EXISTS (
        SELECT 1 FROM requirement r WHERE r.university_id = u.id AND r.exam_type = 'IELTS' AND r.min_score <= 6)""",
)
def listing_search(spark: SparkSession, sf: str) -> DataFrame:
    found = S.search_by_score(_university(spark, sf), _requirement(spark, sf), "IELTS", 6.0)
    return found.select("id", "name_eng", "nation")
