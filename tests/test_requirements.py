"""Requirement texts and notes: documented cases and quirks."""

import pytest

from sheetloom import vocabulary as V
from sheetloom.functions import requirements as R
from sheetloom.operators.regions import fill_region
from sheetloom.operators.requirements import (
    expand_codes,
    extract_requirements,
    mark_available,
    with_open_text,
)
from pyspark.sql import functions as F

CASES = {
    # text, region -> {exam: (score, level)}
    ("A2", None): {"TOEFL": (80, "A2"), "IELTS": (6, "A2"), "TOEIC": (850, "A2"), "TOEFL_ITP": (560, "A2")},
    ("A-2", None): {"TOEFL": (80, "A2"), "IELTS": (6, "A2"), "TOEIC": (850, "A2"), "TOEFL_ITP": (560, "A2")},
    ("B1", None): {"HSK": (6, "CN_B1")},
    ("C1", None): {"JLPT": (1, "JP_C1"), "JPT": (900, "JP_C1")},
    ("D1", None): {"DELF": (2, "D1")},
    ("E2", None): {"ZD": (1, "E2")},
    ("TOEFL 80", None): {"TOEFL": (80, None)},
    ("IELTS 6.5", None): {"IELTS": (6.5, None)},
    ("TOEIC 850", None): {"TOEIC": (850, None)},
    ("토플 80", None): {"TOEFL": (80, None)},
    ("HSK 5급", None): {"HSK": (5, None)},
    ("JLPT N2", None): {"JLPT": (2, None)},
    ("어학 성적 없음", None): {},
    ("N/A", None): {},
    ("", None): {},
    ("   ", None): {},
    (None, None): {},
    ("A2 (TOEIC 제외)", None): {"TOEFL": (80, "A2"), "IELTS": (6, "A2"), "TOEFL_ITP": (560, "A2")},
    ("A2 (ITP 제외)", None): {"TOEFL": (80, "A2"), "IELTS": (6, "A2"), "TOEIC": (850, "A2")},
    # a Korean word between the exam and the exclusion word separates them
    ("TOEIC 850 토플은 제외", None): {"TOEIC": (850, None)},
    # the most lenient of several codes
    ("A2 / A4", None): {"TOEFL": (70, "A4"), "IELTS": (5, "A4"), "TOEIC": (750, "A4"), "TOEFL_ITP": (530, "A4")},
    ("C1, C2", None): {"JLPT": (2, "JP_C2"), "JPT": (600, "JP_C2")},
    # "NA" inside a word waives
    ("TOEIC 700 (final)", None): {},
    # a written score keeps the code of its exam
    ("A-4 IELTS 6.5", None): {"TOEFL": (70, "A4"), "IELTS": (6.5, "A4"), "TOEIC": (750, "A4"), "TOEFL_ITP": (530, "A4")},
    # last score, first level
    ("DELF C2 / DELF C1", "남미"): {"DELF": (3, "C2"), "JLPT": (2, "JP_C2"), "JPT": (600, "JP_C2")},
    # codes fire beside level exams, depending on region
    ("DELF B2", None): {"DELF": (2, "B2"), "HSK": (5, "CN_B2")},
    ("DELF B2", "유럽"): {"DELF": (2, "B2"), "TOEFL": (72, "EU_B2"), "IELTS": (6, "EU_B2"), "TOEIC": (785, "EU_B2")},
    ("DELFB2", None): {"DELF": (0, "DELFB2")},
    ("dele b2", None): {"DELE": (3, "b2"), "HSK": (5, "CN_B2")},
    ("CELI B2", "아시아"): {"CELI": (4, "B2"), "HSK": (5, "CN_B2")},
    # explicit prefixes
    ("EU_B2", None): {"TOEFL": (72, "EU_B2"), "IELTS": (6, "EU_B2"), "TOEIC": (785, "EU_B2")},
    ("유럽권C1", None): {"TOEFL": (95, "EU_C1"), "IELTS": (7, "EU_C1"), "TOEIC": (945, "EU_C1")},
    ("중국어권 B-1", None): {"HSK": (6, "CN_B1")},
    ("일본 C-2", None): {"JLPT": (2, "JP_C2"), "JPT": (600, "JP_C2")},
    ("영어B2", None): {},
    # numbers
    ("TOEIC 1,000 EU_C2", None): {"TOEFL": (114, "EU_C2"), "IELTS": (8, "EU_C2"), "TOEIC": (1000, "EU_C2")},
    ("TOEIC ,,", None): {},
    ("TOEIC ８００", None): {"TOEIC": (800, None)},
    ("TOEFL: 80", None): {},
    ("TOEFL (iBT) 90", None): {"TOEFL": (90, None)},
    ("toefl pbt 560", None): {"TOEFL_ITP": (560, None)},
    ("Duolingo 110, A2", None): {
        "DUOLINGO": (110, "A2"), "TOEFL": (80, "A2"), "IELTS": (6, "A2"), "TOEIC": (850, "A2"), "TOEFL_ITP": (560, "A2"),
    },
    ("JPT 700", None): {"JPT": (700, None)},
    ("TOPIK\n4급", None): {"TOPIK": (4, None)},
}


def test_documented_texts(spark):
    rows = [(i, text, region) for i, (text, region) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, language_requirement string, region string")
    got = {i: {} for i, _, _ in rows}
    for r in extract_requirements(df, keep=["id"]).collect():
        assert r.exam_type not in got[r.id]
        got[r.id][r.exam_type] = (r.min_score, r.level_code)
    for i, text, region in rows:
        assert got[i] == CASES[(text, region)], (text, region)


def test_source_and_group(spark):
    texts = ["A2", "TOEFL 80", "HSK 5급", "A2 TOEFL 90", "JPT 800", "C1", "IELTS 5 IELTS 6"]
    df = spark.createDataFrame([(t, None) for t in texts], "language_requirement string, region string")
    got = {(r[0], r.exam_type): (r.source, r.language_group) for r in extract_requirements(df, keep=["language_requirement"]).collect()}
    assert got[("A2", "TOEFL")] == ("code", "ENGLISH")
    assert got[("TOEFL 80", "TOEFL")] == ("direct", "ENGLISH")
    assert got[("HSK 5급", "HSK")] == ("direct_override", "CHINESE")
    assert got[("A2 TOEFL 90", "TOEFL")] == ("direct_override", "ENGLISH")
    assert got[("JPT 800", "JPT")] == ("direct", "JPT")
    assert got[("C1", "JPT")] == ("code", "JAPANESE")
    assert got[("IELTS 5 IELTS 6", "IELTS")] == ("direct_override", "ENGLISH")


def test_bounded_waiver(spark):
    df = spark.createDataFrame([("TOEIC 700 (final)",), ("N/A",), ("NA.",), (None,)], "t string")
    modes = {
        mode: [r._upper for r in with_open_text(df, "t", mode).collect()] for mode in ("legacy", "bounded")
    }
    assert modes["legacy"] == [None] * 4
    assert modes["bounded"] == ["TOEIC 700 (FINAL)", None, None, None]
    with pytest.raises(ValueError):
        R.is_waived("t", "other")


NOTES = {
    "ITP 제외": ["TOEFL_ITP"],
    "TOEIC 제외": ["TOEIC"],
    "TOEIC, ITP 제외": ["TOEFL_ITP", "TOEIC"],
    "TOEIC/TOEFL ITP 제외": ["TOEFL_ITP", "TOEIC"],
    "* TOEIC 불가": ["TOEIC"],
    "* TOEFL만 인정(IELTS, TOEIC 제외)": ["IELTS", "TOEIC"],
    "* ITP 제외 \n * TOEIC 제외": ["TOEFL_ITP", "TOEIC"],
    "No exclusion here": [],
    "": [],
    None: [],
    # unknown Latin words are skipped
    "TOEFL Home Edition 제외": ["TOEFL"],
    # a word that holds ITP counts, although it is partly Korean
    "토익ITP 제외": ["TOEFL_ITP"],
    "TOEFL IBT 불가": ["TOEFL"],
    "toefl pbt 제외": ["TOEFL_ITP"],
    # a Korean word ends the reading
    "TOEIC 성적 제외": [],
    # windows of two words overlap
    "ITP제외TOEIC 제외": ["TOEFL_ITP"],
    # fifty characters and no more
    "TOEIC" + " " * 45 + "제외": ["TOEIC"],
    "TOEIC" + " " * 46 + "제외": [],
}


def test_notes(spark):
    df = spark.createDataFrame([(n,) for n in NOTES], "note string")
    got = {r.note: r.x for r in df.select("note", R.note_exclusions("note").alias("x")).collect()}
    assert got == NOTES


def test_availability_keeps_the_row(spark):
    df = spark.createDataFrame([("A2", None, "TOEIC 제외")], "language_requirement string, region string, note string")
    df = df.withColumn("banned", R.note_exclusions("note"))
    rows = mark_available(extract_requirements(df, keep=["banned"]), "banned").collect()
    assert {r.exam_type: r.is_available for r in rows} == {
        "TOEFL": True, "IELTS": True, "TOEIC": False, "TOEFL_ITP": True,
    }


def test_standards(spark):
    groups = {code: group for code, group, _, _ in V.STANDARDS}
    assert {c for c, g in groups.items() if g == "ENGLISH"} == {
        "A1", "A2", "A3", "A4", "A5", "EU_A2", "EU_B1", "EU_B2", "EU_C1", "EU_C2",
    }
    assert {c for c, g in groups.items() if g == "FRENCH"} == {"D1", "D2", "D3"}
    assert {c for c, g in groups.items() if g == "GERMAN"} == {"E1", "E2", "E3"}
    assert {c for c, g in groups.items() if g == "CHINESE"} == {"CN_B1", "CN_B2", "CN_B3"}
    assert {c for c, g in groups.items() if g == "JAPANESE"} == {"JP_C1", "JP_C2"}
    assert all(isinstance(score, float) for *_, score in V.STANDARDS)
    coded = spark.createDataFrame([(1, ["A2", "D1"])], "id int, codes array<string>")
    assert expand_codes(coded, V.standards_df(spark)).count() == 5


def test_extraction_is_one_narrow_stage(spark):
    df = spark.range(10).select("id", F.lit("A2").alias("language_requirement"), F.lit("유럽").alias("region"))
    plan = extract_requirements(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_a_nation_counts_once(spark):
    """Repeated lookup keys don't multiply rows; rows with a region need none."""
    rows = spark.createDataFrame([("f", 1, "독일", None), ("f", 2, "독일", "아시아"), ("f", 3, None, None)], "file string, row_idx long, nation string, region string")
    lookup = spark.createDataFrame([("독일", "유럽"), ("독일", "유럽"), ("독일", "a")], "nation string, region string")
    assert [r.region for r in fill_region(rows, lookup).orderBy("row_idx").collect()] == ["유럽", "아시아", "미분류"]
