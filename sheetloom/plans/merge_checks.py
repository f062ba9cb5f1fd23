"""Checking SQL for derived entities and merged tables."""

from __future__ import annotations

from sheetloom import vocabulary as V
from sheetloom.plans import checks as C

_TEXTS = ["name_kor", "name_eng", "nation", "semester", "significant_note", "available_majors"]
ATTRIBUTES = (
    "region, name_kor, min_gpa, significant_note, remark, available_majors, website_url, badge, "
    "is_exchange, is_visit, has_review, review_year, language_score"
)
VALID = "name_kor IS NOT NULL AND name_eng IS NOT NULL AND nation IS NOT NULL"


def entity_select(source: str, regions: str) -> str:
    """Derived columns of every row of a listing; ``regions(nation, region)``."""
    program = C.field("l.program_type", V.DEFAULT_PROGRAM)
    return f"""SELECT l.file, l.row_idx, {', '.join(f"{C.field('l.' + c)} AS {c}" for c in _TEXTS)},
        {C.region_fill('l.region', 'm.region')} AS region, coalesce({C.gpa_number('l.min_gpa')}, 0.0::DOUBLE) AS min_gpa,
        {C.remarks('l.remark', 'l.remark_ref')} AS remark, {C.url('l.website_url')} AS website_url,
        {C.field('l.institution')} AS badge, contains({program}, '교환') AS is_exchange, contains({program}, '방문') AS is_visit,
        {C.has_review('l.review_raw')} AS has_review, {C.review_year('l.review_raw')} AS review_year,
        {C.field('l.language_requirement')} AS language_score
        FROM {source} l LEFT JOIN {regions} m ON m.nation = {C.field('l.nation')}"""


def merged_ctes(entities: str) -> str:
    """CTEs ``university`` and ``requirement`` from ``entities``."""
    return f"""
    valid AS (SELECT * FROM {entities} WHERE {VALID}),
    winner AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name_eng, nation ORDER BY file DESC, row_idx DESC) AS rn FROM valid) v
        WHERE rn = 1),
    firsts AS (SELECT name_eng, nation, row_number() OVER (ORDER BY file, row_idx) AS id FROM (
        SELECT *, row_number() OVER (PARTITION BY name_eng, nation ORDER BY file, row_idx) AS rn FROM valid) v WHERE rn = 1),
    terms AS (SELECT DISTINCT name_eng, nation, semester FROM valid WHERE semester IS NOT NULL),
    accumulated AS (SELECT name_eng, nation, string_agg(semester, ', ' ORDER BY semester DESC) AS semester FROM terms GROUP BY name_eng, nation),
    university AS (SELECT f.id, a.semester, w.nation, w.name_eng, {', '.join('w.' + c.strip() for c in ATTRIBUTES.split(','))}
        FROM winner w JOIN firsts f ON f.name_eng = w.name_eng AND f.nation = w.nation
             JOIN accumulated a ON a.name_eng = w.name_eng AND a.nation = w.nation),
    {C.requirement_ctes('SELECT id, language_score AS text, region FROM university')},
    {C.exclusion_ctes('SELECT id, significant_note AS note FROM university')},
    exams AS {C.values([(i + 1, e) for i, (e, _) in enumerate(V.EXAM_GROUPS)], 'pos, exam')},
    requirement AS (SELECT CAST(r.id * 100 + e.pos AS BIGINT) AS id, r.id AS university_id, r.language_group, r.exam_type, r.min_score,
            r.level_code, b.exam IS NULL AS is_available
        FROM req r JOIN exams e ON e.exam = r.exam_type LEFT JOIN banned b ON b.id = r.id AND b.exam = r.exam_type)"""
