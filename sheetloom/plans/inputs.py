"""Inputs in the shape of the domain, derived from the driver's tables.

The texts are plain SQL that Spark and the checking engine both run, so that
the operators under test start from the same rows on either side.  Names in
braces are tables or other inputs.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.sources.tables import read_table

TABLES = ["region", "nation", "customer", "orders", "part", "events", "documents", "pages"]


DIMENSIONS = ["region", "nation"]


def _case(number: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {number} % {len(values)} {whens} END"


def _quoted(values: list[str | None]) -> list[str]:
    return ["CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "''") + "'" for v in values]


def requirement_text(k: str) -> str:
    n = f"CAST(60 + {k} % 60 AS STRING)"
    texts = _quoted(
        [
            "A-4 IELTS 6.5", "", "유럽 B2", "HSK 5급", "A2 (TOEIC 제외)", "N/A", None, "B-2",
            "C1 JPT 850", "", "D1", "토플 80, 아이엘츠 6.0", "A2 / A4", "DELE B2", "TOEFL ITP 550 A3", "면제",
            "DELF B2 / delf A1", "Duolingo 110, A2", "TOEIC 1,000 EU_C2", "JLPT N2 일본어권 C-1",
            "중국어권 B-1", "TOPIK 4급", "DELFB2", "CELI B2 CILS c1", "ZD B1", "신HSK 6급",
            "TOEFL (iBT) 90 / TOEFL PBT 560", "A3(ITP 제외) 토익 780", "어학  성적 없음", "TOEIC 700 (final)",
            "영어B2 EU_B1 A5", "IETS 5.5 or TOEIC ,, 유럽권C1",
        ]
    )
    texts[1] = f"concat('TOEFL ', {n})"
    texts[9] = f"concat('TOEIC 8', lpad(CAST({k} % 60 AS STRING), 2, '0'))"
    return _case(k, texts)


def note_text(k: str) -> str:
    return _case(
        k,
        _quoted(
            [
                None, "ITP 제외", "TOEIC, ITP 제외", "* TOEIC 불가", "* TOEFL만 인정(IELTS, TOEIC 제외)",
                "No exclusion here", "TOEIC/TOEFL ITP 제외", "* ITP 제외 * TOEIC 제외", "토익ITP 제외",
                "TOEFL Home Edition 제외", "ITP제외TOEIC 제외 단, IELTS 가능",
                "HSK 및 JLPT 성적은 인정하나 아래의 시험은 모두 불가하니 반드시 확인할 것 [TOEFL IBT/Duolingo] 불가",
            ]
        ),
    )


def gpa_text(k: str) -> str:
    return _case(
        k,
        _quoted(
            ["3.0/4.5", "3.2 이상", "85", None, " 2.75 ", "GPA 3.5이상/4.5", "없음", "0.5", "6.1", "120점", "70", ""]
        ),
    )


def review_text(k: str) -> str:
    return _case(
        k,
        _quoted(
            ["Y(2018)", "Y(2013-2019)", "2018", "O", "Yes", "X", None, "none", " - ", "있음", "Other",
             "2015 - 2019 후기", "미확인", "1999", "n"]
        ),
    )


def program_text(k: str) -> str:
    return _case(k, _quoted(["일반교환", "방문", " 교환/방문 ", None, "SAF", ""]))


INPUTS = {
    # The two engines differ in integer division, which is written as floor, and
    # in the name of the position function, which is filled in per engine.
    "d_entity": f"""
        SELECT c_custkey AS id, c_name AS name_eng, concat('대학 ', CAST(c_custkey AS STRING)) AS name_kor,
               n_name AS nation,
               CASE r_name WHEN 'EUROPE' THEN '유럽' WHEN 'ASIA' THEN '아시아' ELSE '미분류' END AS region,
               {requirement_text('c_custkey')} AS language_requirement,
               {note_text('c_custkey')} AS significant_note
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
             JOIN {{region}} ON n_regionkey = r_regionkey""",
    "d_region_map": """
        SELECT CASE WHEN r_name = 'AFRICA' THEN lower(n_name) ELSE n_name END AS nation, r_name AS region
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "d_listing": f"""
        SELECT concat(CAST(year(o_orderdate) AS STRING), '-', CASE WHEN month(o_orderdate) <= 6 THEN '1' ELSE '2' END,
                      ' list.xlsx') AS file,
               o_orderkey AS row_idx,
               CASE WHEN o_orderkey % 53 = 0 THEN '합계' WHEN o_orderkey % 31 = 0 THEN CAST(NULL AS STRING)
                    ELSE concat('대학 ', CAST(c_custkey AS STRING)) END AS name_kor,
               CASE WHEN o_orderkey % 37 = 0 THEN CAST(NULL AS STRING) WHEN o_orderkey % 41 = 0 THEN '  '
                    ELSE c_name END AS name_eng,
               CASE WHEN o_orderkey % 43 = 0 THEN CAST(NULL AS STRING) ELSE n_name END AS nation,
               CASE r_name WHEN 'EUROPE' THEN '유럽' WHEN 'ASIA' THEN '아시아' ELSE '미분류' END AS region,
               CASE WHEN o_orderkey % 29 = 0 OR c_custkey % 40 = 7 THEN CAST(NULL AS STRING)
                    ELSE concat(CAST(year(o_orderdate) AS STRING), '-',
                         CASE WHEN month(o_orderdate) IN (7, 8) THEN '여름' WHEN month(o_orderdate) <= 6 THEN '1' ELSE '2' END)
                    END AS semester,
               {requirement_text('(c_custkey + o_orderkey)')} AS language_requirement,
               {note_text('(c_custkey + o_orderkey)')} AS significant_note,
               {gpa_text('o_orderkey')} AS min_gpa,
               CASE WHEN o_orderkey % 3 = 0 THEN CAST(NULL AS STRING) WHEN o_orderkey % 3 = 1 THEN ' ' ELSE o_orderpriority END AS remark,
               CASE WHEN o_orderkey % 4 = 0 THEN concat(' ref ', o_orderstatus) END AS remark_ref,
               CASE o_orderkey % 4 WHEN 0 THEN concat('see www.u', CAST(c_custkey AS STRING), '.ac.kr/in (main)')
                    WHEN 1 THEN concat('http://u', CAST(c_custkey AS STRING), '.edu') WHEN 2 THEN 'u.example.org/path' END AS website_url,
               CASE WHEN o_orderkey % 5 > 0 THEN concat(c_mktsegment, ' and related fields of study') END AS available_majors,
               {review_text('o_orderkey')} AS review_raw,
               CASE o_orderkey % 7 WHEN 0 THEN 'SAF' WHEN 1 THEN 'ACUCA' WHEN 2 THEN '' WHEN 3 THEN CAST(NULL AS STRING) ELSE c_mktsegment END AS institution,
               {program_text('o_orderkey')} AS program_type
        FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
             JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey""",
    "d_sparse": """
        SELECT user_id AS file, event_id AS row_idx,
               CASE WHEN event_type = 'signup' THEN CAST(value AS STRING) END AS nation,
               CASE WHEN event_type = 'purchase' THEN props END AS region,
               event_type
        FROM {events}""",
    "d_url": """
        SELECT page_id AS id,
               CASE page_id % 6 WHEN 0 THEN concat('홈페이지: ', url)
                    WHEN 1 THEN concat('(www.', substr(url, strpos_of(url, '://') + 3), ')')
                    WHEN 2 THEN substr(url, strpos_of(url, '://') + 3)
                    WHEN 3 THEN concat('[', url, '] 참조')
                    WHEN 4 THEN concat('3.5 / 4.5 ', url)
                    ELSE concat('mail: office@', substr(url, strpos_of(url, '://') + 3)) END AS website_url
        FROM {pages}
        UNION ALL SELECT -1 - page_id, CASE WHEN page_id % 2 = 0 THEN '3.5 / 4.5' END FROM {pages}""",
    "d_text": """
        SELECT doc_id AS id,
               CASE doc_id % 5 WHEN 0 THEN concat('  ', replace(text, ' ', '  '), ' ') WHEN 1 THEN replace(text, 'e', ' \n e')
                    WHEN 2 THEN concat('\u3000', replace(text, 'a', '\u00a0')) ELSE text END AS text
        FROM {documents}
        UNION ALL SELECT -1 - doc_id, repeat(' ', CAST(doc_id % 4 AS INT)) FROM {documents}""",
    "d_document_requirement": f"""
        SELECT doc_id AS id, concat(text, ' ', coalesce({requirement_text('doc_id')}, '')) AS language_requirement,
               CASE WHEN doc_id % 3 = 0 THEN '유럽' ELSE lang END AS region,
               concat(text, ' ', coalesce({note_text('doc_id')}, ''), ' ', text) AS significant_note
        FROM {{documents}}""",
    "d_filename": f"""
        SELECT o_orderkey AS id,
               {_case('o_orderkey', [
                   "concat(y, '-1 교환학생 파견가능대학 및 지원자격(1차).xlsx')", "concat(y, '_여름 교환.xlsx')",
                   "concat('final ', y, '-겨울.xlsx')", "concat('list', y, '_2_2019-1.xls')", "concat('교환 ', y, '.xlsx')",
                   "concat('v12', y, '-2 (2).xlsx')"])} AS file
        FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS STRING) AS y FROM {{orders}}) o""",
    # One spreadsheet per fifty parts: a title row in some files, a header row
    # in one of several spellings, body rows with merged (missing) nations.
    "d_sheet": """
        SELECT f, CAST(p_partkey % 50 AS BIGINT) AS r, p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
               concat(CAST(2022 + f % 4 AS STRING), '-', CAST(1 + f % 2 AS STRING), ' list ',
                      lpad(CAST(f AS STRING), 12, '0'), '.xlsx') AS file,
               CASE WHEN f % 3 = 0 THEN 1 ELSE 0 END AS titled,
               f % 7 AS layout
        FROM (SELECT *, CAST(floor(p_partkey / 50) AS BIGINT) AS f FROM {part}) p""",
}

# Cells of a sheet: column number, header text by layout, and body value.  The
# layouts differ in spelling, duplicates and missing columns; layout 6 has no
# header at all.
SHEET_COLUMNS = [
    (0, ["국가", "파견국가", " 국가명 ", "파견\n국가", "국가", "지역/국가", "x"],
     "CASE WHEN p_partkey % 4 = 0 THEN p_brand END"),
    (1, ["대학명", "대학명(한글)", "파견 대학명(한글)", "대학명", "대학명", "대학명", "y"],
     "CASE WHEN p_partkey % 17 = 0 THEN '소계' WHEN p_partkey % 19 = 0 THEN CAST(NULL AS STRING) ELSE concat('대학  ', p_name) END"),
    (2, ["대학명(영문)", "University Name", "Partner University Name", "대학명(영문)", "University Name", "대학명(영문)", "z"],
     "CASE WHEN p_partkey % 23 = 0 THEN CAST(NULL AS STRING) ELSE concat(p_name, ' ', CAST(p_size AS STRING)) END"),
    (3, ["어학성적", "지원 자격 어학성적", "어학 성적\n(필수)", "어학성적", "", "어학성적", "q"],
     requirement_text("p_partkey")),
    (4, ["최소 학점", "최소 학점(GPA)", "비고", "특이 사항", "최소 학점", "최소 학점", "p"],
     "CAST(p_size AS STRING)"),
    (5, ["비고", "참고사항", "비고(참조)", "비고", "비고", "비고", "r"],
     "CASE WHEN p_partkey % 2 = 0 THEN p_type END"),
    (6, ["비고", "특이사항", "유의사항", "홈페이지", "지역", "구분", "s"],
     "CASE WHEN p_partkey % 3 = 0 THEN concat(p_type, CASE WHEN layout = 6 THEN '' ELSE ' 지역' END) END"),
]
TITLE = "2024학년도 교환학생 안내"



def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the inputs as a DataFrame; only the columns in use are read."""
    text = INPUTS[name].replace("strpos_of(", "instr(")
    used = re.findall(r"\{(\w+)\}", text)
    return spark.sql(text, **{t: read_table(spark, sf_dir, t, small=t in DIMENSIONS) for t in used})


def derived_sql(name: str) -> str:
    """The same input as SQL for the checking engine."""
    return INPUTS[name].replace("strpos_of(", "strpos(").format(**{t: t for t in TABLES})


def sheet_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cell grid of the sheets made from parts.

    Every part is one body row; the first part of a file also gives the title
    and header rows.
    """
    sheet = derived(spark, sf_dir, "d_sheet")
    first_row = F.col("titled") + F.when(F.col("layout") == 6, 0).otherwise(1)
    cells = []
    for col, headers, body in SHEET_COLUMNS:
        header = F.array(*[F.lit(h) for h in headers])[F.col("layout").cast("int")]
        cells.append(_cell(F.lit(True), F.col("r") + first_row, col, F.expr(body)))
        starts = (F.col("r") == 0) & (F.col("layout") < 6)
        cells.append(_cell(starts, F.col("titled").cast("long"), col, header))
    cells.append(_cell((F.col("r") == 0) & (F.col("titled") == 1), F.lit(0).cast("long"), 0, F.lit(TITLE)))
    return sheet.select("file", F.explode(F.array(*cells)).alias("cell")).filter("cell.used").select(
        "file", "cell.row_idx", "cell.col_idx", "cell.value"
    )


def _cell(used: Column, row: Column, col: int, value: Column) -> Column:
    return F.struct(
        used.alias("used"),
        row.alias("row_idx"),
        F.lit(col).alias("col_idx"),
        value.alias("value"),
    )


def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sheets as rows, without putting cells together."""
    sheet = derived(spark, sf_dir, "d_sheet")
    first_row = F.col("titled") + F.when(F.col("layout") == 6, 0).otherwise(1)
    layout = F.col("layout").cast("int")
    header = F.array(*[F.array(*[F.lit(h) for h in headers])[layout] for _, headers, _ in SHEET_COLUMNS])
    body = F.array(*[F.expr(value) for _, _, value in SHEET_COLUMNS])
    first = F.col("r") == 0
    rows = [
        (F.lit(True), F.col("r") + first_row, body),
        (first & (F.col("layout") < 6), F.col("titled").cast("long"), header),
        (first & (F.col("titled") == 1), F.lit(0).cast("long"), F.array(F.lit(TITLE))),
    ]
    packed = F.array(*[F.struct(u.alias("used"), r.alias("row_idx"), v.alias("values")) for u, r, v in rows])
    return sheet.select("file", F.explode(packed).alias("row")).filter("row.used").select("file", "row.row_idx", "row.values")


def sheet_cells_sql() -> str:
    """The same grid as SQL for the checking engine."""
    parts = []
    for col, headers, body in SHEET_COLUMNS:
        whens = " ".join(f"WHEN {i} THEN '{h}'" for i, h in enumerate(headers))
        parts.append(
            f"SELECT file, CAST(r + titled + CASE WHEN layout = 6 THEN 0 ELSE 1 END AS BIGINT) AS row_idx, "
            f"{col} AS col_idx, {body} AS value FROM sheet"
        )
        parts.append(
            f"SELECT file, CAST(titled AS BIGINT), {col}, CASE layout {whens} END FROM sheet WHERE r = 0 AND layout < 6"
        )
    parts.append(f"SELECT file, CAST(0 AS BIGINT), 0, '{TITLE}' FROM sheet WHERE r = 0 AND titled = 1")
    return f"WITH sheet AS ({derived_sql('d_sheet')}) " + " UNION ALL ".join(parts)


def sheet_books(cells: DataFrame) -> DataFrame:
    """``file, content``: the grid's sheets as workbooks, one for each file."""
    return cells.groupBy("file").applyInArrow(_book, "file string, content binary")


def _book(cells: pa.Table) -> pa.Table:
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    lines: dict[int, list[str]] = {}
    own = zip(*(cells[c].to_pylist() for c in ("row_idx", "col_idx", "value")))
    for row, col, value in sorted((c for c in own if c[0] is not None and c[2] is not None), key=lambda c: c[:2]):
        at = f'r="{chr(65 + col)}{row + 1}"'
        number = value.isascii() and value.isdigit()
        cell = f"<c {at}><v>{value}</v></c>" if number else f'<c {at} t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        lines.setdefault(row, []).append(cell)
    rows = [f'<row r="{row + 1}">{"".join(line)}</row>' for row, line in lines.items()]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}"><Relationship Id="r1" Type="t" Target="worksheets/sheet1.xml"/></Relationships>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(rows)}</sheetData></worksheet>')
    return pa.table({"file": pa.array([cells["file"][0].as_py()], pa.string()), "content": pa.array([data.getvalue()], pa.binary())})
