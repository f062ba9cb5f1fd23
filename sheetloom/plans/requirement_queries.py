"""Requirement extraction, exclusions and score search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions import requirements as R
from sheetloom.functions.text import blank_to_null
from sheetloom.operators import search as S
from sheetloom.operators.regions import fill_region
from sheetloom.operators.requirements import (
    expand_codes,
    extract_requirements,
    mark_available,
    with_open_text,
)
from sheetloom.plans import checks as C
from sheetloom.plans.inputs import derived, derived_sql
from sheetloom.plans.registry import query

ENTITY = derived_sql("d_entity")
DOCUMENT = derived_sql("d_document_requirement")
ENTITY_TEXT = f"SELECT id, language_requirement AS text, region FROM ({ENTITY}) e"
DOCUMENT_TEXT = f"SELECT id, language_requirement AS text, region FROM ({DOCUMENT}) e"


def _upper(df: DataFrame) -> DataFrame:
    return df.withColumn("upper", F.upper(blank_to_null("language_requirement")))


@query("requirement_rows", f"WITH {C.requirement_ctes(ENTITY_TEXT)} SELECT * FROM req")
def requirement_rows(spark: SparkSession, sf: str) -> DataFrame:
    return extract_requirements(derived(spark, sf, "d_entity"), keep=["id"])


@query(
    "requirement_rows_documents",
    f"WITH {C.requirement_ctes(DOCUMENT_TEXT, bounded=True)} SELECT * FROM req",
)
def requirement_rows_documents(spark: SparkSession, sf: str) -> DataFrame:
    texts = derived(spark, sf, "d_document_requirement")
    return extract_requirements(texts, keep=["id"], waiver_mode="bounded")


_WAIVER = "coalesce({text} IS NULL OR regexp_matches(text, '(?i)어학\\s*성적?\\s*없음|면제|불필요|{na}'), true) AS {name}"


@query(
    "waivers",
    "SELECT id, "
    + _WAIVER.format(text=C.field("text"), na="N/?A", name="waived")
    + ", "
    + _WAIVER.format(text=C.field("text"), na=rf"(^|{C.WORD})N/?A($|{C.WORD})", name="waived_bounded")
    + f" FROM ({DOCUMENT_TEXT} UNION ALL SELECT -1 - id, text, region FROM ({ENTITY_TEXT}) x) t",
)
def waivers(spark: SparkSession, sf: str) -> DataFrame:
    documents = derived(spark, sf, "d_document_requirement").select("id", "language_requirement")
    entities = derived(spark, sf, "d_entity").select((-1 - F.col("id")).alias("id"), "language_requirement")
    return _upper(documents.unionByName(entities)).select(
        "id",
        R.is_waived("upper").alias("waived"),
        R.is_waived("upper", "bounded").alias("waived_bounded"),
    )


@query(
    "text_exclusions",
    f"""SELECT id, concat_ws(',', CASE WHEN regexp_matches(text, '(?i)ITP[^가-힣]*제외') THEN 'TOEFL_ITP' END,
        CASE WHEN regexp_matches(text, '(?i)(TOEIC|토익)[^가-힣]*제외') THEN 'TOEIC' END) AS excluded
        FROM ({DOCUMENT_TEXT}) t""",
)
def text_exclusions(spark: SparkSession, sf: str) -> DataFrame:
    texts = _upper(derived(spark, sf, "d_document_requirement"))
    return texts.select("id", F.array_join(R.text_exclusions("upper"), ",").alias("excluded"))


@query(
    "grade_codes",
    f"""WITH {C.requirement_ctes(DOCUMENT_TEXT, bounded=True)},
        given AS ({DOCUMENT_TEXT})
        SELECT g.id, coalesce(string_agg(c.code, ',' ORDER BY c.code), '') AS codes
        FROM given g LEFT JOIN codes c ON c.id = g.id GROUP BY g.id""",
)
def grade_codes(spark: SparkSession, sf: str) -> DataFrame:
    texts = derived(spark, sf, "d_document_requirement")
    return with_open_text(texts, "language_requirement", "bounded").select(
        "id", F.array_join(R.grade_codes("_upper", "region"), ",").alias("codes")
    )


@query(
    "code_expansion",
    f"""WITH {C.requirement_ctes(ENTITY_TEXT)} SELECT id, code, category, exam AS exam_type, CAST(score AS DOUBLE) AS score FROM coded""",
)
def code_expansion(spark: SparkSession, sf: str) -> DataFrame:
    texts = with_open_text(derived(spark, sf, "d_entity"), "language_requirement")
    coded = texts.select("id", R.grade_codes("_upper", "region").alias("codes"))
    return expand_codes(coded, V.standards_df(spark))


@query(
    "direct_scores",
    f"WITH {C.requirement_ctes(DOCUMENT_TEXT, bounded=True)} SELECT id, exam AS exam_type, raw, score FROM hits WHERE score IS NOT NULL",
)
def direct_scores(spark: SparkSession, sf: str) -> DataFrame:
    texts = derived(spark, sf, "d_document_requirement")
    hits = with_open_text(texts, "language_requirement", "bounded").select(
        "id", R.direct_hits("_text", "_upper").alias("hits")
    )
    return hits.select("id", F.inline_outer("hits")).filter(F.col("exam_type").isNotNull())


_LEVEL = "replace(regexp_extract(coalesce(language_requirement, ''), '[A-Da-d]-?[1-6]', 0), '-', '')"


@query(
    "level_values",
    f"""WITH levels AS {C.values([(s, l, v) for s, p in V.LEVEL_SCALES.items() for l, v in p], 'scale, level, value')},
        given AS (SELECT id, {_LEVEL} AS level FROM ({ENTITY}) e)
        SELECT g.id, g.level, {', '.join(f"coalesce(max(CAST(v.value AS DOUBLE)) FILTER (WHERE v.scale = '{s}'), 0.0::DOUBLE) AS {s}" for s in V.LEVEL_SCALES)}
        FROM given g LEFT JOIN levels v ON v.level = upper(g.level) GROUP BY g.id, g.level""",
)
def level_values(spark: SparkSession, sf: str) -> DataFrame:
    levels = derived(spark, sf, "d_entity").select("id", F.expr(_LEVEL).alias("level"))
    return levels.select(
        "id", "level", *[R.level_value(F.col("level"), s).alias(s) for s in V.LEVEL_SCALES]
    )


def _exploded_exclusions(texts: DataFrame) -> DataFrame:
    found = texts.select("id", R.note_exclusions("significant_note").alias("exams"))
    return found.select("id", F.explode_outer("exams").alias("exam")).filter(F.col("exam").isNotNull())


@query(
    "note_exclusions",
    f"WITH {C.exclusion_ctes(f'SELECT id, significant_note AS note FROM ({ENTITY}) e')} SELECT id, exam FROM banned",
)
def note_exclusions(spark: SparkSession, sf: str) -> DataFrame:
    return _exploded_exclusions(derived(spark, sf, "d_entity"))


@query(
    "note_exclusions_documents",
    f"WITH {C.exclusion_ctes(f'SELECT id, significant_note AS note FROM ({DOCUMENT}) e')} SELECT id, exam FROM banned",
)
def note_exclusions_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _exploded_exclusions(derived(spark, sf, "d_document_requirement"))


@query(
    "availability",
    f"""WITH {C.requirement_ctes(ENTITY_TEXT)}, {C.exclusion_ctes(f'SELECT id, significant_note AS note FROM ({ENTITY}) e')}
        SELECT r.id, r.exam_type, r.min_score, b.exam IS NULL AS is_available
        FROM req r LEFT JOIN banned b ON b.id = r.id AND b.exam = r.exam_type""",
)
def availability(spark: SparkSession, sf: str) -> DataFrame:
    entities = derived(spark, sf, "d_entity").withColumn(
        "banned", R.note_exclusions("significant_note")
    )
    rows = extract_requirements(entities, keep=["id", "banned"])
    return mark_available(rows, "banned").select("id", "exam_type", "min_score", "is_available")


_FILLED = f"""SELECT e.* EXCLUDE (region), {C.region_fill('e.region', 'm.region')} AS region
    FROM ({ENTITY}) e LEFT JOIN ({derived_sql('d_region_map')}) m ON m.nation = e.nation"""


@query("region_fill", f"SELECT id, nation, region FROM ({_FILLED}) f")
def region_fill(spark: SparkSession, sf: str) -> DataFrame:
    filled = fill_region(derived(spark, sf, "d_entity"), derived(spark, sf, "d_region_map"))
    return filled.select("id", "nation", "region")


_SEARCH = f"""WITH filled AS ({_FILLED}), {C.requirement_ctes('SELECT id, language_requirement AS text, region FROM filled')},
    {C.exclusion_ctes('SELECT id, significant_note AS note FROM filled')}
    SELECT id, name_eng, nation, region FROM filled f WHERE EXISTS (SELECT 1 FROM req r WHERE r.id = f.id AND """


def _search(spark: SparkSession, sf: str, exam: str, score: float, **options: bool) -> DataFrame:
    filled = fill_region(derived(spark, sf, "d_entity"), derived(spark, sf, "d_region_map"))
    entities = filled.withColumn("banned", R.note_exclusions("significant_note"))
    parsed = extract_requirements(entities, keep=["id", "banned"]).withColumnRenamed("id", "university_id")
    found = S.search_by_score(filled, mark_available(parsed, "banned"), exam, score, **options)
    return found.select("id", "name_eng", "nation", "region")


@query("search_by_score", _SEARCH + "r.exam_type = 'TOEFL' AND r.min_score <= 80)")
def search_by_score(spark: SparkSession, sf: str) -> DataFrame:
    return _search(spark, sf, "TOEFL", 80.0)


@query(
    "search_available",
    _SEARCH
    + """r.exam_type = 'TOEIC' AND r.min_score <= 850
        AND NOT EXISTS (SELECT 1 FROM banned b WHERE b.id = r.id AND b.exam = 'TOEIC'))""",
)
def search_available(spark: SparkSession, sf: str) -> DataFrame:
    return _search(spark, sf, "TOEIC", 850.0, available_only=True)


@query("search_direction", _SEARCH + "r.exam_type = 'JLPT' AND r.min_score >= 2)")
def search_direction(spark: SparkSession, sf: str) -> DataFrame:
    return _search(spark, sf, "JLPT", 2.0, direction_aware=True)
