"""Upserts, ids, statistics, search and the incremental load."""

import random

import pytest
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.operators import merge as M
from sheetloom.operators import search as S
from sheetloom.operators.ids import sequence_ids
from sheetloom.plans.ingest import full_load
from sheetloom.session import run_dir
from sheetloom.sources.sinks import read_tables
from sheetloom.streaming.incremental import CatalogueStore, start_incremental

COLUMNS = ["file", "row_idx", *V.CANONICAL_COLUMNS]
SCHEMA = "file string, row_idx long, " + ", ".join(f"{c} string" for c in V.CANONICAL_COLUMNS)


def listing(spark, *rows: dict):
    filled = [
        tuple({"file": "f", "row_idx": i, "semester": "2024-1", **row}.get(c) for c in COLUMNS) for i, row in enumerate(rows)
    ]
    return spark.createDataFrame(filled, SCHEMA)


def row(name: str = "U", **values) -> dict:
    return {"name_kor": "대", "name_eng": name, "nation": "미국", **values}


def load(spark, *rows: dict):
    university, requirements = full_load(M.derive_entities(listing(spark, *rows)))
    by_id = {r.id: r.name_eng for r in university.collect()}
    children = {}
    for r in requirements.collect():
        children.setdefault(by_id[r.university_id], {})[r.exam_type] = r.min_score
    return {r.name_eng: r for r in university.collect()}, children


def test_documented_rows(spark):
    got, _ = load(
        spark,
        row("Moon University", program_type="교환학생", institution="Space Badge", min_gpa="3.5", significant_note="None",
            language_requirement="TOEFL 100", website_url="http://moon.edu", available_majors="Space Science", review_raw="X"),
        row("Review University", nation="Review Land", program_type="교환학생", institution="Review Badge", min_gpa="3.5",
            language_requirement="TOEFL 100", website_url="http://review.edu", review_raw="Y(2023)"),
    )
    moon, review = got["Moon University"], got["Review University"]
    assert (moon.badge, moon.region, moon.min_gpa, moon.has_review) == ("Space Badge", "북미", 3.5, False)
    assert (review.has_review, review.review_year, review.region) == (True, "2023", "미분류")
    assert review.is_exchange and not review.is_visit


def test_last_row_wins_with_its_nulls(spark):
    got, children = load(
        spark,
        row(available_majors="m", language_requirement="A2", semester="2023-2", remark="x"),
        row(available_majors=None, language_requirement="TOEFL 90", semester="2024-여름"),
        row("Cleared", language_requirement="A1"),
        row("Cleared", language_requirement="면제"),
        row("Blank", language_requirement="A1"),
        row("Blank", language_requirement=" "),
    )
    assert got["U"].available_majors is None and got["U"].remark == ""
    assert got["U"].semester == "2024-여름, 2023-2"
    assert children == {"U": {"TOEFL": 90.0}}
    assert [got[n].id for n in ("U", "Cleared", "Blank")] == [1, 2, 3]


def test_files_are_ordered_by_name(spark):
    got, _ = load(
        spark,
        row(file="2024-2", row_idx=0, institution="new", semester="2024-2"),
        row(file="2024-1", row_idx=9, institution="old", semester="2024-1, 2022-1"),
    )
    assert got["U"].badge == "new" and got["U"].semester == "2024-2, 2024-1, 2022-1"


def test_keys_are_exact_and_required(spark):
    entities = M.derive_entities(
        listing(spark, row("a"), row("A"), row(" a "), row("a", nation="일본"), row(None), row("b", name_kor=" "), row("c", nation=None))
    )
    valid, skipped = M.split_valid(entities)
    assert skipped.count() == 3
    keys = {(r.name_eng, r.nation) for r in M.collapse(valid).collect()}
    assert keys == {("a", "미국"), ("A", "미국"), ("a", "일본")}


def test_entities_without_semester_are_rejected(spark):
    got, _ = load(spark, row("a", semester=None), row("b", semester=None), row("b", semester="2024-1"), row("b", semester=None))
    assert set(got) == {"b"} and got["b"].semester == "2024-1"
    states = M.collapse(M.derive_entities(listing(spark, row("a", semester=None), row("a", semester=" "), row("b"))))
    assert [(r.name_eng, r.row_idx) for r in M.rejected_entities(states).collect()] == [("a", 1)]


def test_stats(spark):
    entities = M.derive_entities(
        listing(
            spark,
            row("a", file="f1", language_requirement="A2"),
            row("a", file="f1", language_requirement="TOEFL 80"),
            row(None, file="f1", language_requirement="A2"),
            row("a", file="f2"),
            row("b", file="f2", language_requirement="HSK 4급"),
        )
    )
    stats = {r.file: tuple(r)[1:] for r in M.load_stats(entities).collect()}
    assert stats == {"f1": (1, 1, 1, 5), "f2": (1, 1, 0, 1)}
    known = spark.createDataFrame([("a", "미국")], "name_eng string, nation string")
    assert {r.file: r.inserted for r in M.load_stats(entities, known).collect()} == {"f1": 0, "f2": 1}


def test_ids_are_dense_over_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("k"))
    rows = sequence_ids(df, ["k"], start=100).orderBy("k").collect()
    assert [r.id for r in rows] == list(range(101, 5101))


def _random_rows(seed: int, n: int) -> list[dict]:
    rng = random.Random(seed)
    texts = ["A2", "TOEFL 80", "HSK 5급", "면제", None, "B2", "A4 IELTS 6"]
    return [
        row(
            rng.choice(["hot"] * 5 + [f"u{i}" for i in range(40)]),
            file=f"202{rng.randint(0, 4)}-1.xlsx",
            row_idx=i,
            semester=rng.choice(["2020-1", "2021-여름", "2021-2", None]),
            language_requirement=rng.choice(texts),
            significant_note=rng.choice([None, "TOEIC 제외", "ITP 불가"]),
            institution=rng.choice([None, "x", "y"]),
        )
        for i in range(n)
    ]


def _snapshot(university, requirements, ids: bool = True):
    names = {r.id: (r.name_eng, r.nation) for r in university.select("id", "name_eng", "nation").collect()}
    hide = () if ids else ("id",)
    rows = sorted(map(str, university.drop(*hide).collect()))
    children = sorted(
        (names[r.university_id], r.exam_type, r.min_score, str(r.level_code), r.is_available) for r in requirements.collect()
    )
    return rows, children


def test_result_does_not_depend_on_partitioning(spark):
    entities = M.derive_entities(listing(spark, *_random_rows(1, 600)))
    one = _snapshot(*full_load(entities.coalesce(1)))
    many = _snapshot(*full_load(entities.repartition(17, F.rand(3))))
    assert one == many


def test_batches_equal_one_load(spark):
    rows = _random_rows(2, 400)
    expected = _snapshot(*full_load(M.derive_entities(listing(spark, *rows))), ids=False)
    store = CatalogueStore(spark, run_dir(spark, "test-store"))
    store.reset()
    files = sorted({r["file"] for r in rows})
    late_first = [files[2], files[0], *files[3:], files[1]]
    for batch, file in enumerate(late_first):
        part = listing(spark, *[r for r in rows if r["file"] == file])
        store.apply(M.derive_entities(part), batch)
        if batch == 2:
            store.compact(1)
    university, requirements = store.university(), store.language_requirement()
    assert _snapshot(university, requirements, ids=False) == expected
    ids = [r.id for r in store.states().select("id").collect()]
    assert len(ids) == len(set(ids)) and None not in ids
    # a replay of the last batch, and of everything, leaves the tables as they are
    before = _snapshot(university, requirements)
    store.apply(M.derive_entities(listing(spark, *[r for r in rows if r["file"] == late_first[-1]])), len(files) - 1)
    assert _snapshot(store.university(), store.language_requirement()) == before
    store.apply(M.derive_entities(listing(spark, *rows)), len(files))
    assert _snapshot(store.university(), store.language_requirement()) == before
    assert S.orphans(store.language_requirement(), store.university()).count() == 0
    store.reset()
    assert store.states().count() == 0


def test_stream_equals_one_load(spark, tmp_path):
    rows = _random_rows(3, 300)
    whole = listing(spark, *rows)
    whole.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    store = CatalogueStore(spark, str(tmp_path / "store"))
    start_incremental(stream, M.derive_entities, store, str(tmp_path / "checkpoint")).awaitTermination()
    expected = _snapshot(*full_load(M.derive_entities(whole)), ids=False)
    assert _snapshot(store.university(), store.language_requirement(), ids=False) == expected
    # nothing new has arrived
    again = start_incremental(stream, M.derive_entities, store, str(tmp_path / "checkpoint"))
    again.awaitTermination()
    assert again.lastProgress is None or again.lastProgress["numInputRows"] == 0


def test_snapshot_and_search(spark, tmp_path):
    entities = M.derive_entities(
        listing(
            spark,
            row("a", language_requirement="TOEFL 80"),
            row("b", language_requirement="A2", significant_note="TOEFL 제외"),
            row("c", language_requirement="JLPT N1"),
            row("d", language_requirement="JLPT N3"),
            row("e"),
        )
    )
    full_load(entities, str(tmp_path))
    university, requirements = read_tables(spark, str(tmp_path))

    def found(*args, **options):
        return {r.name_eng for r in S.search_by_score(university, requirements, *args, **options).collect()}

    assert found("TOEFL", 80.0) == {"a", "b"} and found("TOEFL", 79.0) == set()
    assert found("TOEFL", 80.0, available_only=True) == {"a"}
    assert found("JLPT", 2.0) == {"c"} and found("JLPT", 2.0, direction_aware=True) == {"d"}
    nested = {r.name_eng: r.labels for r in S.nested_requirements(university, requirements).collect()}
    assert nested["b"] == ["IELTS 6 (A2)", "TOEFL 80 (A2)", "TOEFL_ITP 560 (A2)", "TOEIC 850 (A2)"] and nested["e"] == []
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = S.search_by_score(university, requirements, "TOEFL", 80.0)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(exam_type,TOEFL)" in plan and "LessThanOrEqual(min_score,80.0)" in plan
    assert [r.exam_type for r in S.requirements_of(requirements, 1).collect()] == ["TOEFL"]


def test_reset_keeps_no_ids(spark):
    store = CatalogueStore(spark, run_dir(spark, "test-reset"))
    for _ in range(2):
        store.reset()
        store.apply(M.derive_entities(listing(spark, row("a"), row("b"))), 0)
        assert sorted(r.id for r in store.university().collect()) == [1, 2]


def test_folding_on_the_way(spark):
    """Folded batches, equal positions and later terms: the later batch wins, all terms stay."""
    store = CatalogueStore(spark, run_dir(spark, "test-fold"), compact_every=2)
    for batch, (text, semester) in enumerate([("A1", "2023-1"), ("A2", "2023-2"), ("A3", "2024-1"), ("A4", "2024-2")]):
        store.apply(M.derive_entities(listing(spark, row("a", language_requirement=text, semester=semester))), batch)
        got = store.university().collect()
        assert [r.language_score for r in got] == [text]
    assert got[0].semester == "2024-2, 2024-1, 2023-2, 2023-1"


@pytest.mark.parametrize("single", ["2024-1", "2024-1, 2023-1"])
def test_a_single_semester_text_stays(spark, single):
    got, _ = load(spark, row(semester=single))
    assert got["U"].semester == single
