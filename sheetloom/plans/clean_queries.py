"""Value cleaning, filters and single-field extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions import fields as X
from sheetloom.operators import clean as K
from sheetloom.operators import reports as A
from sheetloom.operators import search as S
from sheetloom.operators.merge import has_keys
from sheetloom.plans import checks as C
from sheetloom.plans.inputs import derived, derived_sql
from sheetloom.plans.registry import query
from sheetloom.sources.tables import read_table

LISTING = derived_sql("d_listing")
KEYS_SQL = f"{C.field('name_kor')} IS NOT NULL AND {C.field('name_eng')} IS NOT NULL AND {C.field('nation')} IS NOT NULL"


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "d_listing")


def _keyed(spark: SparkSession, sf: str) -> DataFrame:
    return _listing(spark, sf).withColumns({c: X.field(c) for c in V.REQUIRED_COLUMNS})


@query(
    "forward_fill",
    f"""SELECT file, row_idx, event_type,
        last_value(nation IGNORE NULLS) OVER w AS nation, last_value(region IGNORE NULLS) OVER w AS region
        FROM ({derived_sql('d_sparse')}) s
        WINDOW w AS (PARTITION BY file ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    return K.forward_fill(derived(spark, sf, "d_sparse"), ["nation", "region"])


@query("whitespace", f"SELECT id, {C.collapse('text')} AS text FROM ({derived_sql('d_text')}) t")
def whitespace(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "d_text").select("id", X.collapse_whitespace("text").alias("text"))


@query(
    "program_type",
    f"SELECT row_idx, replace({C.strip('program_type || chr(10)')}, chr(10), '') AS program_type FROM ({LISTING}) l",
)
def program_type(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat("program_type", F.lit("\n"))
    return _listing(spark, sf).select("row_idx", X.clean_program_type(raw).alias("program_type"))


@query("gpa_normalise", f"SELECT row_idx, {C.gpa_text('min_gpa')} AS min_gpa FROM ({LISTING}) l")
def gpa_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return _listing(spark, sf).select("row_idx", X.normalise_gpa("min_gpa").alias("min_gpa"))


@query("gpa_parse", f"SELECT row_idx, {C.gpa_number('min_gpa')} AS min_gpa FROM ({LISTING}) l")
def gpa_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _listing(spark, sf).select("row_idx", X.gpa_number("min_gpa").alias("min_gpa"))


@query("url_extract", f"SELECT id, {C.url('website_url')} AS website_url FROM ({derived_sql('d_url')}) u")
def url_extract(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "d_url").select("id", X.first_url("website_url").alias("website_url"))


@query(
    "review_parse",
    f"SELECT row_idx, {C.has_review('review_raw')} AS has_review, {C.review_year('review_raw')} AS review_year FROM ({LISTING}) l",
)
def review_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _listing(spark, sf).select(
        "row_idx",
        X.has_review("review_raw").alias("has_review"),
        X.review_year("review_raw").alias("review_year"),
    )


@query("remark_concat", f"SELECT row_idx, {C.remarks('remark', 'remark_ref')} AS remark FROM ({LISTING}) l")
def remark_concat(spark: SparkSession, sf: str) -> DataFrame:
    return _listing(spark, sf).select("row_idx", X.join_remarks(X.field("remark"), X.field("remark_ref")).alias("remark"))


_PROGRAM = C.field("program_type", V.DEFAULT_PROGRAM)


@query(
    "program_flags",
    f"""SELECT row_idx, {_PROGRAM} AS program_type, contains({_PROGRAM}, '교환') AS is_exchange,
        contains({_PROGRAM}, '방문') AS is_visit FROM ({LISTING}) l""",
)
def program_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _listing(spark, sf).select(
        "row_idx",
        X.field("program_type", V.DEFAULT_PROGRAM).alias("program_type"),
        X.is_exchange(X.field("program_type")).alias("is_exchange"),
        X.is_visit(X.field("program_type")).alias("is_visit"),
    )


@query(
    "summary_filter",
    f"""SELECT row_idx, name_kor, nation FROM ({LISTING}) l
        WHERE (name_kor IS NOT NULL OR nation IS NOT NULL) AND name_kor IS NOT NULL
          AND NOT regexp_matches(name_kor, '합계|소계|총계')""",
)
def summary_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = K.drop_summary_rows(K.drop_empty_rows(_listing(spark, sf)))
    return kept.select("row_idx", "name_kor", "nation")


@query(
    "summary_filter_nan",
    f"""SELECT doc_id AS id, text AS name_kor FROM documents
        WHERE NOT regexp_matches(text, '(?i)합계|소계|총계|nan')""",
)
def summary_filter_nan(spark: SparkSession, sf: str) -> DataFrame:
    texts = read_table(spark, sf, "documents").withColumnRenamed("text", "name_kor")
    kept = K.drop_summary_rows(texts, nan_rule=True)
    return kept.select(F.col("doc_id").alias("id"), "name_kor")


@query("required_keys", f"SELECT row_idx, file FROM ({LISTING}) l WHERE {KEYS_SQL}")
def required_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _keyed(spark, sf).filter(has_keys()).select("row_idx", "file")


@query(
    "key_totals",
    f"""SELECT count(*) FILTER (WHERE ok) AS valid_rows, count(*) FILTER (WHERE NOT ok) AS invalid_rows
        FROM (SELECT {KEYS_SQL} AS ok FROM ({LISTING}) l) k""",
)
def key_totals(spark: SparkSession, sf: str) -> DataFrame:
    return A.key_totals(_keyed(spark, sf))


@query(
    "invalid_sample",
    f"""SELECT file, row_idx, {C.field('name_kor')} AS name_kor, {C.field('name_eng')} AS name_eng, {C.field('nation')} AS nation
        FROM ({LISTING}) l WHERE NOT ({KEYS_SQL}) ORDER BY file, row_idx LIMIT 5""",
)
def invalid_sample(spark: SparkSession, sf: str) -> DataFrame:
    return A.invalid_sample(
        _keyed(spark, sf).select("file", "row_idx", *V.REQUIRED_COLUMNS), ["file", "row_idx"]
    )


@query(
    "institution_filter",
    f"SELECT row_idx, institution FROM ({LISTING}) l WHERE institution IS NULL OR institution NOT IN ('SAF', 'ACUCA')",
)
def institution_filter(spark: SparkSession, sf: str) -> DataFrame:
    return K.drop_institutions(_listing(spark, sf)).select("row_idx", "institution")


@query(
    "gpa_report",
    f"""SELECT name_eng, {C.gpa_text('min_gpa')} AS min_gpa FROM ({LISTING}) l
        WHERE regexp_matches(name_eng, '(?i)customer#0000000[0-4]|CUSTOMER#.*77')""",
)
def gpa_report(spark: SparkSession, sf: str) -> DataFrame:
    named = S.name_matches(_listing(spark, sf), "name_eng", ["customer#0000000[0-4]", "CUSTOMER#.*77"])
    return named.select("name_eng", X.normalise_gpa("min_gpa").alias("min_gpa"))
