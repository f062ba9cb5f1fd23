"""From cell grids to clean listings, and whole runs over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions import fields as X
from sheetloom.operators import grid as G
from sheetloom.plans import checks as C
from sheetloom.plans import ingest as I
from sheetloom.plans.inputs import derived, derived_sql, sheet_books, sheet_cells, sheet_cells_sql, sheet_rows
from sheetloom.plans.merge_checks import entity_select, merged_ctes
from sheetloom.plans.registry import query
from sheetloom.session import run_dir
from sheetloom.sources.sinks import read_csv, write_csv, write_lines
from sheetloom.sources.workbook import decode, decode_rows

_SYNONYMS = [(i, s, c) for i, (s, c) in enumerate(V.HEADER_SYNONYMS)]

GRID = f"""
    cells AS ({sheet_cells_sql()}),
    synonyms AS {C.values(_SYNONYMS, 'priority, synonym, canonical')},
    toprows AS (SELECT file, row_idx, string_agg(replace(upper(value), chr(10), ' '), ' ' ORDER BY col_idx) AS line
        FROM cells WHERE row_idx < 10 AND {C.field('value')} IS NOT NULL GROUP BY file, row_idx),
    heads AS (SELECT file, min(row_idx) AS header_row FROM toprows t
        WHERE EXISTS (SELECT 1 FROM synonyms s WHERE contains(t.line, upper(s.synonym))) GROUP BY file),
    hcells AS (SELECT c.file, h.header_row, c.col_idx,
            coalesce(nullif(replace({C.strip('c.value')}, chr(10), ' '), ''), 'Unnamed_' || CAST(c.col_idx AS STRING)) AS header
        FROM cells c JOIN heads h ON h.file = c.file AND h.header_row = c.row_idx),
    ranked AS (SELECT h.*, s.canonical, row_number() OVER (PARTITION BY h.file, h.col_idx
            ORDER BY (s.synonym = h.header) DESC, length(s.synonym) DESC, s.priority) AS rn
        FROM hcells h LEFT JOIN synonyms s ON contains(h.header, s.synonym)),
    canon AS (SELECT file, header_row, col_idx, header, coalesce(canonical, header) AS canonical FROM ranked WHERE rn = 1),
    mapped AS (SELECT *, CASE WHEN nth = 0 THEN canonical ELSE canonical || '_' || CAST(nth AS STRING) END AS col
        FROM (SELECT *, row_number() OVER (PARTITION BY file, canonical ORDER BY col_idx) - 1 AS nth FROM canon) n)"""

TABLE = f"""{GRID},
    body AS (SELECT c.file, c.row_idx, {', '.join(f"max(c.value) FILTER (WHERE m.col = '{c}') AS {c}" for c in V.CANONICAL_COLUMNS)}
        FROM cells c JOIN heads h ON h.file = c.file LEFT JOIN mapped m ON m.file = c.file AND m.col_idx = c.col_idx
        WHERE c.row_idx > h.header_row GROUP BY c.file, c.row_idx)"""

_HAS = "EXISTS (SELECT 1 FROM mapped m WHERE m.file = b.file AND m.col = '{0}')"
_SEMESTER = (
    "coalesce(nullif(regexp_extract({0}, '^([0-9]{{4}})[-_]([0-9]|여름|겨울)', 1) || '-' || regexp_extract({0}, '^([0-9]{{4}})[-_]([0-9]|여름|겨울)', 2), '-'), "
    "nullif(regexp_extract({0}, '([0-9]{{4}})[-_]([0-9]|여름|겨울)', 1) || '-' || regexp_extract({0}, '([0-9]{{4}})[-_]([0-9]|여름|겨울)', 2), '-'), 'Unknown')"
)

BACKFILLED = f"""{TABLE},
    reffile AS (SELECT max(file) AS file FROM cells WHERE regexp_matches(file, '^202[45].*\\.xlsx$')),
    refmap AS (SELECT nation, arg_max(region, row_idx) AS region FROM body
        WHERE file = (SELECT file FROM reffile) AND nation IS NOT NULL AND region IS NOT NULL GROUP BY nation),
    filled AS (SELECT b.* EXCLUDE (region), CASE WHEN contains(b.file, '2023') AND NOT {_HAS.format('region')} AND {_HAS.format('nation')}
            THEN coalesce(r.region, 'Unknown') ELSE b.region END AS region
        FROM body b LEFT JOIN refmap r ON r.nation = b.nation)"""

EXTRACTED = f"""{BACKFILLED},
    extracted AS (SELECT b.* EXCLUDE (semester), b.file AS filename, 'Unknown' AS recruitment_round,
        CASE WHEN {_HAS.format('semester')} THEN semester ELSE {_SEMESTER.format('b.file')} END AS semester FROM filled b)"""


def _cleaned_sql(source: str) -> str:
    values = []
    for c in V.CANONICAL_COLUMNS:
        raw = f"replace({C.strip(c)}, chr(10), '')" if c == "program_type" else c
        value = C.collapse(raw)
        values.append(f"{C.gpa_text(value) if c == 'min_gpa' else value} AS {c}")
    fill = ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in V.FILLED_COLUMNS)
    return f"""
    tidy AS (SELECT file, row_idx, {', '.join(values)} FROM {source}),
    spread AS (SELECT * EXCLUDE ({', '.join(V.FILLED_COLUMNS)}), {fill} FROM tidy
        WINDOW w AS (PARTITION BY file ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    cleaned AS (SELECT * FROM spread b WHERE (name_kor IS NOT NULL OR nation IS NOT NULL)
        AND ((name_kor IS NULL AND NOT {_HAS.format('name_kor')}) OR NOT regexp_matches(name_kor, '합계|소계|총계')))"""


CLEANED = f"{EXTRACTED}, {_cleaned_sql('extracted')}"
_REGION_VALUES = C.values(V.NATION_REGIONS, "nation, region")
ENTITIES = f"{CLEANED}, entities AS ({entity_select('cleaned', _REGION_VALUES)})"
_LIST = ", ".join(V.CANONICAL_COLUMNS)


def entities_of(cells: str) -> str:
    """The CTEs up to ``entities`` over other cells."""
    return ENTITIES.replace(f"cells AS ({sheet_cells_sql()})", f"cells AS ({cells})")


def _grid(spark: SparkSession, sf: str) -> DataFrame:
    return sheet_rows(spark, sf)


def _mapped(spark: SparkSession, sf: str) -> DataFrame:
    grid = _grid(spark, sf)
    return G.header_map(grid, G.header_rows(grid))


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    """The grid as a written table, as a run over workbooks has it."""
    return I.stage_grid(_grid(spark, sf))


@query("header_detect", f"WITH {GRID} SELECT file, header_row FROM heads")
def header_detect(spark: SparkSession, sf: str) -> DataFrame:
    return G.header_rows(_grid(spark, sf))


@query("header_map", f"WITH {GRID} SELECT file, header_row, col_idx, header, canonical, col AS \"column\" FROM mapped")
def header_map(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf)


@query("dup_columns", f"WITH {GRID} SELECT file, col_idx, col AS \"column\" FROM mapped WHERE col <> canonical")
def dup_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf).filter(F.col("column") != F.col("canonical")).select("file", "col_idx", "column")


@query("grid_to_table", f"WITH {TABLE} SELECT file, row_idx, {_LIST} FROM body")
def grid_to_table(spark: SparkSession, sf: str) -> DataFrame:
    grid = _grid(spark, sf)
    table = G.grid_to_table(grid, G.header_map(grid, G.header_rows(grid)))
    return table.select("file", "row_idx", *V.CANONICAL_COLUMNS)


@query("bad_files", f"WITH {GRID} SELECT DISTINCT file, 'no header row' AS reason FROM cells WHERE file NOT IN (SELECT file FROM heads)")
def bad_files(spark: SparkSession, sf: str) -> DataFrame:
    grid = _grid(spark, sf)
    return G.files_without_header(grid, G.header_rows(grid))


@query(
    "header_audit",
    f"""WITH {GRID}, required AS {C.values([(i, c) for i, c in enumerate(V.REQUIRED_COLUMNS)], 'pos, col')}
        SELECT f.file, f.columns, coalesce((SELECT string_agg(r.col, ',' ORDER BY r.pos) FROM required r
            WHERE NOT EXISTS (SELECT 1 FROM mapped m WHERE m.file = f.file AND m.col = r.col)), '') AS missing
        FROM (SELECT file, string_agg(col, ',' ORDER BY col_idx) AS columns FROM mapped GROUP BY file) f""",
)
def header_audit(spark: SparkSession, sf: str) -> DataFrame:
    audit = G.header_audit(_mapped(spark, sf))
    return audit.select("file", *[F.array_join(c, ",").alias(c) for c in ("columns", "missing")])


@query(
    "first_files",
    f"WITH {GRID} SELECT file, col_idx, col AS \"column\" FROM mapped WHERE file IN (SELECT DISTINCT file FROM mapped ORDER BY file LIMIT 3)",
)
def first_files(spark: SparkSession, sf: str) -> DataFrame:
    return G.first_files(_mapped(spark, sf)).select("file", "col_idx", "column")


@query("latest_file", f"WITH cells AS ({sheet_cells_sql()}) SELECT * FROM cells WHERE file = (SELECT max(file) FROM cells)")
def latest_file(spark: SparkSession, sf: str) -> DataFrame:
    return G.latest_file(sheet_cells(spark, sf))


@query(
    "semester_from_name",
    f"SELECT id, {_SEMESTER.format('file')} AS semester FROM ({derived_sql('d_filename')}) f",
)
def semester_from_name(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "d_filename").select("id", X.file_semester("file").alias("semester"))


@query("region_backfill", f"WITH {BACKFILLED} SELECT file, row_idx, nation, region FROM filled")
def region_backfill(spark: SparkSession, sf: str) -> DataFrame:
    return I.assemble(_staged(spark, sf)).select("file", "row_idx", "nation", "region")


@query("metadata_inject", f"WITH {EXTRACTED} SELECT file, row_idx, filename, semester, recruitment_round FROM extracted")
def metadata_inject(spark: SparkSession, sf: str) -> DataFrame:
    listing = I.extract_listing(_staged(spark, sf))
    return listing.select("file", "row_idx", "filename", "semester", "recruitment_round")


@query("cleaned_listing", f"WITH {CLEANED} SELECT file, row_idx, {_LIST} FROM cleaned")
def cleaned_listing(spark: SparkSession, sf: str) -> DataFrame:
    result = I.ingest_grid(_staged(spark, sf))
    return result.cleaned.select("file", "row_idx", *V.CANONICAL_COLUMNS)


@query(
    "stage_counts",
    f"""WITH {ENTITIES} SELECT b.file, count(*) AS extracted,
        (SELECT count(*) FROM cleaned c WHERE c.file = b.file) AS cleaned,
        (SELECT count(*) FROM entities e WHERE e.file = b.file AND e.name_kor IS NOT NULL AND e.name_eng IS NOT NULL AND e.nation IS NOT NULL) AS loaded
        FROM body b GROUP BY b.file""",
)
def stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    return I.ingest_grid(_staged(spark, sf)).counts


_MERGED = f"WITH {ENTITIES}, {merged_ctes('entities')}"


@query("catalogue_university", f"{_MERGED} SELECT * FROM university")
def catalogue_university(spark: SparkSession, sf: str) -> DataFrame:
    return I.merged_university(I.ingest_grid(_staged(spark, sf)).entities)


@query("catalogue_requirement", f"{_MERGED} SELECT * FROM requirement")
def catalogue_requirement(spark: SparkSession, sf: str) -> DataFrame:
    return I.full_load(I.ingest_grid(_staged(spark, sf)).entities)[1]


@query("workbook_cells", f"WITH {GRID} SELECT file, row_idx, col_idx, value FROM cells WHERE value IS NOT NULL")
def workbook_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The sheets as workbooks, and what is read from them."""
    return decode(sheet_books(sheet_cells(spark, sf))).select("file", "row_idx", "col_idx", "value")


@query("workbook_university", f"{_MERGED} SELECT * FROM university")
def workbook_university(spark: SparkSession, sf: str) -> DataFrame:
    """The whole run from workbooks to entities."""
    return I.merged_university(I.ingest_rows(decode_rows(sheet_books(sheet_cells(spark, sf)))).entities)


_EXPORT = f"WITH {BACKFILLED}, {_cleaned_sql('filled')}"


@query("csv_roundtrip", f"{_EXPORT} SELECT file, row_idx, {', '.join(f'nullif({c}, chr(0)) AS {c}' for c in V.CANONICAL_COLUMNS)} FROM cleaned")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "csv")
    write_csv(I.export_table(_staged(spark, sf)), path)
    columns = ", ".join(f"{c} string" for c in V.CANONICAL_COLUMNS)
    return read_csv(spark, path, f"file string, row_idx bigint, {columns}")


def _csv(v: str) -> str:
    quoted = f"""'"' || replace({v}, '"', '""') || '"'"""
    return f"""CASE WHEN {v} IS NULL THEN '' WHEN {v} = '' OR regexp_matches({v}, '[",\\s]') THEN {quoted} ELSE {v} END"""


_OWN = " ".join(f"WHEN '{c}' THEN c.{c}" for c in V.CANONICAL_COLUMNS)


@query(
    "csv_files",
    f"""{_EXPORT},
        added AS (SELECT DISTINCT file FROM mapped b WHERE contains(file, '2023') AND NOT {_HAS.format('region')} AND {_HAS.format('nation')}),
        own AS (SELECT c.file, c.row_idx, m.col_idx, CASE m.col {_OWN} ELSE {C.collapse('k.value')} END AS v
            FROM cleaned c JOIN mapped m ON m.file = c.file
                 LEFT JOIN cells k ON k.file = c.file AND k.row_idx = c.row_idx AND k.col_idx = m.col_idx),
        lines AS (SELECT file, row_idx, string_agg({_csv('v')}, ',' ORDER BY col_idx) AS line FROM own GROUP BY file, row_idx)
        SELECT c.file, l.line || CASE WHEN a.file IS NULL THEN '' ELSE ',' || {_csv('c.region')} END AS line
        FROM cleaned c JOIN lines l ON l.file = c.file AND l.row_idx = c.row_idx LEFT JOIN added a ON a.file = c.file
        UNION ALL SELECT m.file, string_agg({_csv('m.col')}, ',' ORDER BY m.col_idx) || CASE WHEN max(a.file) IS NULL THEN '' ELSE ',region' END
        FROM mapped m LEFT JOIN added a ON a.file = m.file GROUP BY m.file""",
)
def csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """Each file as CSV with all of its own columns, as written and read back."""
    path = run_dir(spark, "csv_files")
    write_lines(I.export_lines(_staged(spark, sf)), path)
    return spark.read.schema("line string, file string").text(path)
