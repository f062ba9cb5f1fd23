"""Headers, canonical columns, rows, and cleaning."""

import random

import pytest
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions import fields as X
from sheetloom.operators import clean as K
from sheetloom.operators import grid as G
from sheetloom.plans.ingest import assemble, extract_listing, ingest_grid, stage_grid

SCHEMA = "file string, row_idx long, col_idx int, value string"


def make_grid(spark, sheets: dict[str, list[list]]):
    cells = [
        (file, r, c, value) for file, rows in sheets.items() for r, row in enumerate(rows) for c, value in enumerate(row)
    ]
    return spark.createDataFrame(cells, SCHEMA)


def test_header_row(spark):
    grid = make_grid(
        spark,
        {
            "a": [["x"], [None, " "], ["국가", "대학명"], ["국가", "b"]],
            "title": [["교환학생 지원자격 안내"], ["국가", "대학명"]],
            "split": [["지원", "자격"], ["국가"]],
            "late": [["x"]] * 10 + [["국가"]],
            "case": [["university\nname"]],
            "none": [["x", "y"]],
        },
    )
    found = G.header_rows(grid)
    assert {r.file: r.header_row for r in found.collect()} == {"a": 2, "title": 0, "split": 0, "case": 0}
    assert {r.file for r in G.files_without_header(grid, found).collect()} == {"late", "none"}


HEADERS = {
    "국가": "nation",
    " 국가명 ": "nation",
    "파견국가 (지역)": "nation",  # the longest spelling wins
    "지역/국가": "region",  # equal length: the one listed first
    "지원 자격\n어학성적": "language_requirement",
    "지원 자격 특이사항 등": "significant_note",
    "비고(참조)": "remark_ref",
    "비고 (참조)": "remark",
    "교환학생수기 여부(Y/N)": "review_raw",
    "website": "website",  # mapping minds the case
    "Website (EN)": "website_url",
    "어학조건": "어학조건",
    "": "Unnamed_12",
    None: "Unnamed_13",
}


def test_header_mapping_and_suffixes(spark):
    grid = make_grid(spark, {"f": [list(HEADERS)]})
    mapped = G.header_map(grid, G.header_rows(grid)).orderBy("col_idx").collect()
    assert [r.canonical for r in mapped] == list(HEADERS.values())
    names = [r.column for r in mapped]
    assert names[:3] == ["nation", "nation_1", "nation_2"] and len(set(names)) == len(names)


def test_only_the_first_of_equal_columns_is_read(spark):
    table = assemble(stage_grid(make_grid(spark, {"f": [["국가", "국가명", "대학명"], ["a", "b", "c"], [None, "d", "e"]]})))
    assert [(r.nation, r.name_kor) for r in table.orderBy("row_idx").collect()] == [("a", "c"), (None, "e")]


def test_blocks_do_not_change_the_table(spark, monkeypatch):
    rows = [["국가", "대학명", "어학성적"]] + [[f"n{i}" if i % 7 == 0 else None, f"u{i}", "A1"] for i in range(200)]
    grid = make_grid(spark, {"long": rows, "short": rows[:5]})
    mapped = G.header_map(grid, G.header_rows(grid))
    whole = {tuple(r[:6]) for r in G.grid_to_table(grid, mapped).select("file", "row_idx", *V.CANONICAL_COLUMNS).collect()}
    monkeypatch.setattr(G.row_block, "__defaults__", (16,))
    split = {tuple(r[:6]) for r in G.grid_to_table(grid, mapped).select("file", "row_idx", *V.CANONICAL_COLUMNS).collect()}
    assert split == whole and len(whole) == 204


def test_semester_presence_is_per_column(spark):
    grid = make_grid(
        spark,
        {
            "2024-1 a.xlsx": [["국가", "대학명", "파견학기"], ["x", "y", "2020-1"], ["x", "z", None]],
            "2024_겨울 b.xlsx": [["국가", "대학명"], ["x", "y"]],
        },
    )
    rows = extract_listing(stage_grid(grid)).orderBy("file", "row_idx").collect()
    assert [r.semester for r in rows] == ["2020-1", None, "2024-겨울"]
    assert {r.recruitment_round for r in rows} == {"Unknown"} and rows[0].filename == "2024-1 a.xlsx"


@pytest.mark.parametrize("reference", ["2025-1 ref.xlsx", "~2025 lock.xlsx"])
def test_region_backfill(spark, reference):
    grid = make_grid(
        spark,
        {
            "2023-1 old.xlsx": [["국가", "대학명"], ["미국", "a"], [None, "b"], ["독일", "c"]],
            "2023-2 own.xlsx": [["국가", "대학명", "지역"], ["미국", "a", None]],
            "2024-1 ref.xlsx": [["국가", "지역", "대학명"], ["독일", "Europe", "x"]],
            reference: [["국가", "지역", "대학명"], ["미국", "America", "x"], ["미국", "North", "y"], ["독일", None, "z"]],
        },
    )
    got = {(r.file, r.name_kor): r.region for r in assemble(stage_grid(grid)).collect()}
    used_2025 = not reference.startswith("~")
    assert got[("2023-1 old.xlsx", "a")] == ("North" if used_2025 else "Unknown")
    assert got[("2023-1 old.xlsx", "b")] == "Unknown"
    assert got[("2023-1 old.xlsx", "c")] == ("Unknown" if used_2025 else "Europe")
    assert got[("2023-2 own.xlsx", "a")] is None


def test_semester_of_file_names(spark):
    names = {
        "2024-1 교환학생 파견가능대학 및 지원자격(1차).xlsx": "2024-1",
        "2023-여름 교환.xlsx": "2023-여름",
        "list 2023_2 of 2021-1.xlsx": "2023-2",
        "2022_겨울.xlsx": "2022-겨울",
        "x12024-2.xlsx": "2024-2",
        "2024.xlsx": "Unknown",
    }
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r.n: r.s for r in df.select("n", X.file_semester("n").alias("s")).collect()} == names


def test_clean_drops_and_collapses(spark):
    rows = [("f", 1, "미국", "Harvard"), ("f", 2, None, None), ("f", 3, "일본", "Tokyo"), ("f", 4, "  x  ", "A   B\n\tC"),
            ("f", 5, "x", "소계 3"), ("f", 6, "x", "Nanjing")]
    df = spark.createDataFrame(rows, "file string, row_idx long, nation string, name_kor string").withColumns(
        {"region": F.lit(None).cast("string"), "program_type": F.lit(" 교\n환 "), "institution": F.lit(None).cast("string"), "min_gpa": F.lit("3.0")}
    )
    got = K.clean(df).orderBy("row_idx").collect()
    assert [(r.nation, r.name_kor) for r in got] == [("미국", "Harvard"), ("일본", "Tokyo"), ("x", "A B C"), ("x", "Nanjing")]
    assert got[0].program_type == "교환" and got[0].min_gpa == "3.0/4.5"
    assert "Nanjing" not in {r.name_kor for r in K.clean(df, nan_rule=True).collect()}
    assert K.drop_institutions(df.withColumn("institution", F.lit("SAF"))).count() == 0


@pytest.mark.parametrize("block_rows", [1, 3, 50, 65536])
def test_forward_fill_in_blocks(spark, block_rows):
    rng = random.Random(block_rows)
    rows = [(f, i, rng.choice([None, None, "", "a", "b"]), rng.choice([None] * 9 + ["z"])) for f in "pq" for i in range(120)]
    df = spark.createDataFrame(rows, "file string, row_idx long, x string, y string").repartition(5)
    expected, last = {}, {}
    for f, i, x, y in rows:
        for name, value in (("x", x), ("y", y)):
            if value is not None:
                last[f, name] = value
        expected[f, i] = (last.get((f, "x")), last.get((f, "y")))
    got = K.forward_fill(df, ["x", "y"], block_rows=block_rows)
    assert got.columns == df.columns
    collected = got.collect()
    assert len(collected) == len(rows)
    assert {(r.file, r.row_idx): (r.x, r.y) for r in collected} == expected


def test_fill_runs_before_rows_are_dropped(spark):
    grid = make_grid(spark, {"2024-1.xlsx": [["국가", "대학명"], ["미국", "합계"], [None, "MIT"], [" ", "Blank"], [None, "After"]]})
    rows = ingest_grid(stage_grid(grid)).cleaned.orderBy("row_idx").collect()
    assert [(r.nation, r.name_kor) for r in rows] == [("미국", "MIT"), (" ", "Blank"), (" ", "After")]


def test_a_file_without_names_counts_as_skipped(spark):
    from sheetloom.operators.merge import load_stats

    grid = make_grid(spark, {"2024-1.xlsx": [["국가", "비고"], ["미국", "x"]], "2024-2.xlsx": [["국가", "대학명"], ["미국", None]]})
    stats = {r.file: r.skipped for r in load_stats(ingest_grid(stage_grid(grid)).entities).collect()}
    assert stats == {"2024-1.xlsx": 1}


def test_header_audit(spark):
    grid = make_grid(spark, {"a": [["국가", "대학명"]], "b": [["대학명(영문)", "국가", "대학명"]]})
    audit = {r.file: r for r in G.header_audit(G.header_map(grid, G.header_rows(grid))).collect()}
    assert audit["a"].missing == ["name_eng"] and audit["b"].missing == []
    assert audit["b"].columns == ["name_eng", "nation", "name_kor"]


def test_rows_are_never_the_side_that_is_broadcast(spark):
    """Staged rows are far smaller on disk than in memory, so their size there mustn't decide."""
    sheets = {f"2023-1 {i:05d}.xlsx": [["국가", "대학명"]] + [["프랑스", "x"]] * 12 for i in range(300)}
    rows = [(file, r, own) for file, body in sheets.items() for r, own in enumerate(body)]
    grid = stage_grid(spark.createDataFrame(rows, "file string, row_idx long, values array<string>"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "40k")
    try:
        mapped = G.header_map(grid, G.header_rows(grid))
        table = G.grid_to_table(grid, mapped)
        for found, n in ((mapped, 600), (table, 3600)):
            assert len(found.collect()) == n
            assert "BuildLeft" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
