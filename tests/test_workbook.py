"""Workbook scan and the run over a folder of workbooks."""

import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sheetloom.plans.ingest import (
    assemble,
    export_lines,
    export_table,
    full_load,
    ingest_workbooks,
    stage_grid,
    watch_workbooks,
)
from sheetloom.session import shared_dir
from sheetloom.sources.sinks import read_csv, read_tables, write_csv, write_lines
from sheetloom.sources.workbook import _number_text, list_workbooks, read_workbooks, sheet_cells
from sheetloom.streaming.incremental import CatalogueStore
from workbooks import _MAIN as MAIN
from workbooks import write_workbook

BASIC = [["국가", "대학명", "어학조건"], ["미국", "Harvard", "TOEFL 100"], ["일본", "Tokyo University", "JLPT N1"]]


def _cells(spark, path, **options):
    return {
        (r.row_idx, r.col_idx): r.value for r in read_workbooks(spark, str(path), **options).collect() if r.error is None
    }


def test_cells(spark, tmp_path):
    write_workbook(
        tmp_path / "a.xlsx",
        [["not this one"]],
        [["한글 text", 3.0, 3.5, True], [None, "inline:x<y", "formula:7", 1e20, -0.25]],
        active=1,
    )
    assert _cells(spark, tmp_path) == {
        (0, 0): "한글 text", (0, 1): "3", (0, 2): "3.5", (0, 3): "True",
        (1, 0): None, (1, 1): "x<y", (1, 2): "7", (1, 3): "1e+20", (1, 4): "-0.25",
    }


def _table(spark, path):
    grid = stage_grid(read_workbooks(spark, str(path)))
    return assemble(grid).orderBy("row_idx").collect()


def test_basic_sheet(spark, tmp_path):
    rows = _table(spark, write_workbook(tmp_path / "test.xlsx", BASIC))
    assert [(r.nation, r.name_kor) for r in rows] == [("미국", "Harvard"), ("일본", "Tokyo University")]
    assert rows[0].language_requirement is None  # 어학조건 is no known spelling


def test_merged_cells_stay_null(spark, tmp_path):
    rows = _table(
        spark,
        write_workbook(tmp_path / "m.xlsx", [["국가", "대학명"], ["미국", "Harvard"], [None, "MIT"]], merges=["A2:A3"]),
    )
    assert [r.nation for r in rows] == ["미국", None]


def test_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_workbooks(spark, str(tmp_path / "nonexistent.xlsx")).collect()


def test_folder_listing(spark, tmp_path):
    for name in ("b 한글+%20(1차).xlsx", "a.xlsx", "~$a.xlsx", "c.xls", "notes.txt"):
        write_workbook(tmp_path / name, BASIC)
    names = [r.file for r in list_workbooks(spark, str(tmp_path)).select("file").orderBy("file").collect()]
    assert names == ["a.xlsx", "b 한글+%20(1차).xlsx", "c.xls"]
    latest = list_workbooks(spark, str(tmp_path), latest_only=True).select("file").collect()
    assert [r.file for r in latest] == ["c.xls"]
    single = list_workbooks(spark, str(tmp_path / "a.xlsx")).select("file").collect()
    assert [r.file for r in single] == ["a.xlsx"]


HEADER = ["국가", "대학명", "대학명(영문)", "어학성적", "최소 학점", "비고", "비고(참조)", "구분", "특이사항"]


def _folder(tmp_path):
    write_workbook(
        tmp_path / "2024-1 교환학생(1차).xlsx",
        [["안내"], HEADER,
         ["미국", "하버드", "Harvard", "TOEFL 100", "3.5 이상", "r1", "r2", "일반\n교환", None],
         [None, "엠아이티", "MIT", "A1", 85, None, None, None, "TOEIC 제외"],
         ["합계", "합계", None, "2", None, None, None, None, None]],
    )
    write_workbook(
        tmp_path / "2024-2 교환학생(1차).xlsx",
        [HEADER, ["미국", "하버드", "Harvard", "면제", None, None, None, "방문", None],
         ["일본", "도쿄", None, "JLPT N1", None, None, None, None, None]],
    )
    write_workbook(tmp_path / "no header.xlsx", [["a", "b"], ["c", "d"]])
    write_workbook(tmp_path / "empty.xlsx", [])
    (tmp_path / "broken.xlsx").write_bytes(b"PK not a zip")
    (tmp_path / "old.xls").write_bytes(b"\xd0\xcf\x11\xe0")


def test_whole_run(spark, tmp_path):
    _folder(tmp_path)
    run = ingest_workbooks(spark, str(tmp_path))
    bad = {r.file: r.reason for r in run.bad_files.collect()}
    assert set(bad) == {"no header.xlsx", "empty.xlsx", "broken.xlsx", "old.xls"}
    assert bad["no header.xlsx"] == "no header row" and "BadZipFile" in bad["broken.xlsx"]
    university, requirements = full_load(run.entities)
    rows = {r.name_eng: r for r in university.collect()}
    assert set(rows) == {"Harvard", "MIT"}
    harvard, mit = rows["Harvard"], rows["MIT"]
    assert (harvard.id, mit.id) == (1, 2)
    assert harvard.semester == "2024-2, 2024-1"
    assert (harvard.min_gpa, harvard.remark, harvard.is_exchange, harvard.is_visit) == (0.0, "", False, True)
    assert (mit.nation, mit.region, mit.min_gpa, mit.is_exchange) == ("미국", "북미", 85.0, True)
    got = {(r.university_id, r.exam_type): (r.min_score, r.is_available) for r in requirements.collect()}
    assert got == {
        (2, "TOEFL"): (85.0, True), (2, "IELTS"): (6.5, True), (2, "TOEIC"): (900.0, False), (2, "TOEFL_ITP"): (600.0, True),
    }


def test_arriving_workbooks(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    _folder(source)
    late = source / "2024-2 교환학생(1차).xlsx"
    content = late.read_bytes()
    late.write_bytes(b"still copying")
    store = CatalogueStore(spark, str(tmp_path / "store"))
    for _ in range(2):
        watch_workbooks(spark, str(source), store, str(tmp_path / "checkpoint"), files_per_batch=2).awaitTermination()
        (source / "2024-2 교환학생(2차).xlsx").write_bytes(content)
    rows = {r.name_eng: r for r in store.university().collect()}
    assert set(rows) == {"Harvard", "MIT"}
    assert rows["Harvard"].semester == "2024-2, 2024-1" and rows["Harvard"].is_visit
    assert {r.exam_type for r in store.language_requirement().collect()} == {"TOEFL", "IELTS", "TOEIC", "TOEFL_ITP"}
    assert sorted(r.id for r in rows.values()) == [1, 2]


def test_export_has_no_file_semester(spark, tmp_path):
    _folder(tmp_path)
    cells = read_workbooks(spark, str(tmp_path)).filter(F.col("error").isNull()).drop("error")
    rows = export_table(stage_grid(cells)).collect()
    assert {r.semester for r in rows} == {None}
    assert {r.min_gpa for r in rows} == {"3.5/4.5", "85/4.5", None}


REFERENCE = [["지역", "국가", "대학명", "대학명(영문)"], ["유럽", "독일", "뮌헨", "Munich"], ["중동", "터키", "앙카라", "Ankara"]]
WITHOUT_REGION = [["국가", "대학명", "대학명(영문)", "어학성적"], ["독일", "베를린", "Berlin", "B2"], [None, "본", "Bonn", "B2"]]


@pytest.mark.parametrize("batch", [1, 1000])
def test_batches_do_not_decide_regions(spark, tmp_path, batch):
    """A reference file fills regions of files of any batch, also of earlier ones."""
    source = tmp_path / "in"
    source.mkdir()
    write_workbook(source / "2023-1 list.xlsx", WITHOUT_REGION)
    store = CatalogueStore(spark, str(tmp_path / "store"))
    if batch == 1:
        watch_workbooks(spark, str(source), store, str(tmp_path / "c"), 1).awaitTermination()
        assert {r.region for r in store.university().collect()} == {"Unknown"}
    write_workbook(source / "2024-1 list.xlsx", REFERENCE)
    watch_workbooks(spark, str(source), store, str(tmp_path / "c"), batch).awaitTermination()
    university, requirements = full_load(ingest_workbooks(spark, str(source)).entities)
    stored = {r.name_eng: r.region for r in store.university().collect()}
    assert stored == {r.name_eng: r.region for r in university.collect()}
    assert stored["Berlin"] == "유럽"
    exams = [sorted((r.exam_type, r.min_score) for r in t.collect()) for t in (store.language_requirement(), requirements)]
    assert exams[0] == exams[1] and exams[0]


def test_equal_names_in_two_folders(spark, tmp_path):
    for folder, name in (("x", "Uni X"), ("y", "Uni Y")):
        (tmp_path / folder).mkdir()
        write_workbook(tmp_path / folder / "2024-1.xlsx", [["국가", "대학명", "대학명(영문)"], ["미국", name, name]])
    run = ingest_workbooks(spark, str(tmp_path / "*"))
    rows = {(r.name_kor, r.filename, r.semester) for r in run.cleaned.collect()}
    assert rows == {("Uni X", "2024-1.xlsx", "2024-1"), ("Uni Y", "2024-1.xlsx", "2024-1")}
    assert run.cleaned.select("file").distinct().count() == 2


def test_export_keeps_all_columns_and_blanks(spark, tmp_path):
    head = ["국가", "대학명", "비고", "비고", "기숙사", "비고(참조)"]
    write_workbook(tmp_path / "2024-1.xlsx", [head, ["미국", "A", "r1", "r2", ' a,"b" ', None], ["미국", "B", None, "", "on\ncampus", "x"]])
    cells = read_workbooks(spark, str(tmp_path)).drop("error")
    lines = [r.line for r in export_lines(stage_grid(cells)).orderBy("row_idx").collect()]
    assert lines[0] == "nation,name_kor,remark,remark_1,기숙사,remark_ref"
    assert lines[1] == '미국,A,r1,r2,"a,""b""",' and lines[2].startswith("미국,B,,") and lines[2].endswith('"on campus",x')
    write_lines(export_lines(stage_grid(cells)), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 3
    table = spark.createDataFrame([(" x ", "  ", "", None)], "a string, b string, c string, d string")
    write_csv(table, str(tmp_path / "csv"))
    assert read_csv(spark, str(tmp_path / "csv"), table.schema.simpleString()[7:-1].replace(":", " ")).collect() == table.collect()


def test_numbers_follow_their_stored_text():
    shown = {"1000000000000000": "1000000000000000", "123456789012345678": "123456789012345678", "85.0": "85", "1E+16": "1e+16", "0.1": "0.1"}
    assert {text: _number_text(text) for text in shown} == shown


def test_date_cells(tmp_path):
    path = write_workbook(tmp_path / "d.xlsx", [[45292, 45292.5, 0.375, 7]])
    styles = (
        f'<styleSheet xmlns="{MAIN}"><numFmts><numFmt numFmtId="164" formatCode="yyyy&quot;년&quot; m"/>'
        '<numFmt numFmtId="165" formatCode="0.00&quot;days&quot;[Red]"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/>'
        '<xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>'
    )
    with zipfile.ZipFile(path) as old:
        parts = {n: old.read(n) for n in old.namelist()}
    sheet = parts["xl/worksheets/sheet1.xml"].decode()
    for ref, style in (("A1", 1), ("B1", 2), ("C1", 1), ("D1", 3)):
        sheet = sheet.replace(f'<c r="{ref}"', f'<c r="{ref}" s="{style}"')
    parts |= {"xl/worksheets/sheet1.xml": sheet.encode(), "xl/styles.xml": styles.encode()}
    with zipfile.ZipFile(path, "w") as book:
        for name, content in parts.items():
            book.writestr(name, content)
    values = [v for _, _, v in sheet_cells(open(path, "rb"))]
    assert values == ["2024-01-01 00:00:00", "2024-01-01 12:00:00", "09:00:00", "7"]


def test_snapshots_switch_as_a_whole(spark, tmp_path):
    _folder(tmp_path)
    entities = ingest_workbooks(spark, str(tmp_path)).entities
    target = str(tmp_path / "tables")
    first = [t.count() for t in full_load(entities, target)]
    (tmp_path / "tables" / "snapshot-2" / "university").mkdir(parents=True)
    assert [t.count() for t in read_tables(spark, target)] == first
    full_load(entities, target)
    assert [t.count() for t in read_tables(spark, target)] == first


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        get = staticmethod(lambda key, default: None)

    class Session:
        conf = Conf

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)
