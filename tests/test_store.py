"""The incremental store: buckets, removals, generations, files set aside, and files written anew."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from sheetloom.operators import merge as M
from sheetloom.operators.ids import hash_ids, key_hash
from sheetloom.plans.ingest import full_load, ingest_workbooks, merge_files, watch_workbooks
from sheetloom.session import run_dir
from sheetloom.sources.changes import FileVersionReader, VersionLog
from sheetloom.sources.sinks import read_tables
from sheetloom.streaming.incremental import CatalogueStore
from test_merge import SCHEMA, _random_rows, _snapshot, listing, row
from workbooks import write_workbook

HEADER = ["국가", "대학명", "대학명(영문)", "어학성적"]


def _store(spark, name: str, **options) -> CatalogueStore:
    return CatalogueStore(spark, run_dir(spark, name), **({"stats": False} | options))


def _entities(spark, *rows):
    return M.derive_entities(listing(spark, *rows))


def _removals(spark, *rows):
    return spark.createDataFrame(rows, "name_eng string, nation string, file string, row_idx long")


# Buckets and commits.


def test_a_batch_reads_the_buckets_of_its_keys(spark):
    store = _store(spark, "buckets", buckets=32)
    store.apply(_entities(spark, *[row(f"u{i}") for i in range(200)]), 0)
    keys = _entities(spark, row("u3"), row("u4"))
    wanted = store.touched(keys)
    assert 1 <= len(wanted) <= 2
    stored = store.stored(keys)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert 2 <= stored.count() < 60
    files = stored.select(F.input_file_name().alias("f")).distinct().collect()
    folders = {os.path.dirname(r.f).rpartition("/")[2] for r in files}
    assert folders == {f"bucket={b}" for b in wanted}


def test_a_batch_writes_only_what_it_touches(spark):
    store = _store(spark, "written", buckets=32)
    store.apply(_entities(spark, *[row(f"u{i}") for i in range(200)]), 0)
    before = store._last(store._folder())
    store.apply(_entities(spark, row("u3", row_idx=500, institution="new")), 1)
    after = store._last(store._folder())
    changed = [b for b in after.buckets if after.buckets[b] != before.buckets.get(b)]
    assert len(changed) == 1 and after.last_id == before.last_id == 200
    assert {r.name_eng: r.badge for r in store.university().filter("badge IS NOT NULL").collect()} == {"u3": "new"}


def test_replaced_versions_are_deleted_and_readers_go_on(spark):
    store = _store(spark, "swept", buckets=1, compact_every=1)
    for batch in range(2):
        store.apply(_entities(spark, row("a", institution=f"b{batch}")), batch)
    reader = store.university()
    for batch in range(2, 5):
        store.apply(_entities(spark, row("a", institution=f"b{batch}")), batch)
        if batch == 2:
            assert [r.badge for r in reader.collect()] == ["b1"]
    versions = {f.split("/commit=")[1].split("/")[0] for f in spark.read.parquet(f"{store._folder()}/state").inputFiles()}
    assert versions == {"4", "5"}
    assert [r.badge for r in store.university().collect()] == ["b4"]


def test_an_unfinished_commit_is_not_seen(spark, monkeypatch):
    store = _store(spark, "unfinished")
    store.apply(_entities(spark, row("a")), 0)

    def lost(*args):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(CatalogueStore, "_sweep", lost)
        patch.setattr("sheetloom.streaming.incremental.asdict", lost)
        with pytest.raises(RuntimeError):
            store.apply(_entities(spark, row("b")), 1)
    assert [r.name_eng for r in store.university().collect()] == ["a"]
    store.apply(_entities(spark, row("b")), 1)
    assert sorted((r.name_eng, r.id) for r in store.university().collect()) == [("a", 1), ("b", 2)]


def test_batches_are_told_apart_by_writer(spark):
    store = _store(spark, "writers")
    for writer in ("one", "two", "one"):
        store.apply(_entities(spark, row(writer)), 0, writer=writer)
    assert sorted(r.name_eng for r in store.university().collect()) == ["one", "two"]
    with pytest.raises(ValueError):
        store.apply(_entities(spark, row("x")), 1, writer="a/b")


# Statistics.


def test_statistics_of_batches(spark):
    store = _store(spark, "stats", stats=True)
    first = store.apply(_entities(spark, row("a", file="f1", language_requirement="A2"), row(None, file="f1")), 0)
    assert [tuple(r)[:5] for r in first.collect()] == [("f1", 1, 0, 1, 4)]
    second = _entities(spark, row("a", file="f2"), row("b", file="f2", language_requirement="HSK 4급"))
    for _ in range(2):
        assert [tuple(r)[:5] for r in store.apply(second, 1).collect()] == [("f2", 1, 1, 0, 1)]
    assert store.stats().count() == 2


# Removals.


@pytest.mark.parametrize("seed", [1, 2])
def test_removals_in_any_order_equal_one_load(spark, seed):
    dice = random.Random(seed)
    rows = _random_rows(seed, 300)
    gone = [("hot", "미국", f"202{dice.randint(0, 3)}-1.xlsx", dice.randrange(300))]
    gone += [(f"u{dice.randrange(40)}", "미국", f"202{dice.randint(0, 4)}-1.xlsx", dice.randrange(300)) for _ in range(25)]
    expected = _snapshot(*full_load(_entities(spark, *rows), deleted=_removals(spark, *gone)), ids=False)
    untouched = _snapshot(*full_load(_entities(spark, *rows)), ids=False)
    assert expected != untouched
    store, parts = _store(spark, "removed"), [[] for _ in range(4)]
    for r in rows:
        parts[dice.randrange(4)].append(r)
    for batch, part in enumerate(parts):
        deleted = _removals(spark, *gone[batch::4])
        store.apply(_entities(spark, *part), batch, deleted=deleted)
    assert _snapshot(store.university(), store.language_requirement(), ids=False) == expected


def test_a_later_row_brings_an_entity_back(spark):
    store = _store(spark, "back")
    store.apply(_entities(spark, row("a", row_idx=1, semester="2020-1", language_requirement="A2"), row("b", row_idx=2)), 0)
    store.apply(_entities(spark), 1, deleted=_removals(spark, ("a", "미국", "f", 5)))
    assert [r.name_eng for r in store.university().collect()] == ["b"] and store.language_requirement().count() == 0
    store.apply(_entities(spark, row("a", row_idx=3, semester="2021-1")), 2)
    assert [r.name_eng for r in store.university().collect()] == ["b"]
    stats = CatalogueStore(spark, store.path).apply(_entities(spark, row("a", row_idx=6, semester="2022-1")), 3)
    assert {r.name_eng: r.semester for r in store.university().collect()} == {"a": "2022-1", "b": "2024-1"}
    assert [r.inserted for r in stats.collect()] == [1]


# Generations.


def test_a_refresh_takes_over_at_once(spark, monkeypatch):
    store = _store(spark, "refresh")
    store.apply(_entities(spark, row("a"), row("b")), 0)
    open_before = store.university()
    seen = []
    publish = CatalogueStore._publish

    def watched(self, generation):
        seen.append(sorted(r.name_eng for r in store.university().collect()))
        publish(self, generation)

    monkeypatch.setattr(CatalogueStore, "_publish", watched)
    store.refresh(_entities(spark, row("c")))
    assert seen == [["a", "b"]]
    assert [r.name_eng for r in store.university().collect()] == ["c"]
    assert sorted(r.name_eng for r in open_before.collect()) == ["a", "b"]
    store.apply(_entities(spark, row("d")), 0)
    assert sorted(r.name_eng for r in store.university().collect()) == ["c", "d"]


# Ids that follow from keys.


def test_hash_ids_and_their_collisions(spark):
    keys = [(f"n{i}", "x") for i in range(60)] + [(None, "x"), ("n1", None)]
    df = spark.createDataFrame(keys, "name_eng string, nation string")
    ids, collisions = hash_ids(df, M.KEY, bits=6)
    rows = ids.collect()
    assert len(rows) == len(keys) - 2 + 2 and len({r.id for r in rows}) == len(keys)
    hashes = {(r.name_eng, r.nation): r.h for r in df.select("*", key_hash(M.KEY, 6).alias("h")).collect()}
    groups = {}
    for key, h in hashes.items():
        groups.setdefault(h, []).append(key)
    assert {(r.name_eng, r.nation) for r in collisions.collect()} == {k for g in groups.values() if len(g) > 1 for k in g}
    assert all(r.id >> 4 == hashes[r.name_eng, r.nation] for r in rows)
    with pytest.raises(ValueError):
        hash_ids(df, M.KEY, bits=1)


def test_hash_ids_do_not_depend_on_arrival(spark):
    rows = _random_rows(5, 200)
    snapshots = []
    for order in (lambda i: 0, lambda i: i % 3, lambda i: 2 - i % 3):
        store = _store(spark, "hashed", ids="hash")
        for batch in range(3):
            store.apply(_entities(spark, *[r for r in rows if order(r["row_idx"]) == batch]), batch)
        snapshots.append(_snapshot(store.university(), store.language_requirement()))
    assert snapshots[0] == snapshots[1] == snapshots[2]


# Files set aside, and files written anew.


def test_quarantine_counts_attempts_and_lets_go(spark):
    store = _store(spark, "aside")
    names = "file string, reason string"

    def batch(number, files, bad):
        all_files = spark.createDataFrame([(f,) for f in files], "file string")
        store.apply(_entities(spark), number, files=all_files, bad_files=spark.createDataFrame(bad, names))
        return sorted(tuple(r) for r in store.quarantine().collect())

    assert batch(0, "abc", [("a", "x"), ("b", "y")]) == [("a", "x", 0, 1), ("b", "y", 0, 1)]
    for _ in range(2):  # the second is a replay
        assert batch(1, "a", [("a", "z")]) == [("a", "z", 1, 2), ("b", "y", 0, 1)]
    assert batch(2, "ab", [("b", "y")]) == [("b", "y", 2, 2)]
    assert batch(3, "d", []) == [("b", "y", 2, 2)]
    assert batch(4, "b", []) == []
    assert batch(5, "b", [("b", "new"), ("b", "again")]) == [("b", "again", 5, 1)]


def test_a_stream_sets_bad_workbooks_aside_and_takes_them_back(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    store = CatalogueStore(spark, str(tmp_path / "store"), stats=False)

    def run():
        watch_workbooks(spark, str(source), store, str(tmp_path / "c")).awaitTermination()
        return {r.file: (r.reason.split(":")[0], r.attempt) for r in store.quarantine().collect()}

    write_workbook(source / "2024-1 good.xlsx", [HEADER, ["미국", "a", "A", "TOEFL 80"]])
    write_workbook(source / "2024-1 headless.xlsx", [["x"], ["y"]])
    (source / "2024-1 broken.xlsx").write_bytes(b"still copying")
    assert run() == {"2024-1 headless.xlsx": ("no header row", 1), "2024-1 broken.xlsx": ("BadZipFile", 1)}
    assert [r.name_eng for r in store.university().collect()] == ["A"]
    (source / "2024-1 broken.xlsx").write_bytes(b"still copying some more")
    assert run() == {"2024-1 headless.xlsx": ("no header row", 1), "2024-1 broken.xlsx": ("BadZipFile", 2)}
    write_workbook(source / "2024-1 broken.xlsx", [HEADER, ["미국", "b", "B", None]])
    assert run() == {"2024-1 headless.xlsx": ("no header row", 1)}
    assert sorted(r.name_eng for r in store.university().collect()) == ["A", "B"]
    commits = store._commits(store._folder())
    assert run() == {"2024-1 headless.xlsx": ("no header row", 1)} and store._commits(store._folder()) == commits


def test_a_file_written_anew_wins_over_its_first_version(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    store = CatalogueStore(spark, str(tmp_path / "store"))
    file = source / "2024-1 list.xlsx"
    write_workbook(file, [HEADER, ["미국", "b", "B", "A1"], ["미국", "a", "A", "TOEFL 80"]])
    watch_workbooks(spark, str(source), store, str(tmp_path / "c")).awaitTermination()
    write_workbook(file, [HEADER, ["미국", "a2", "A", "TOEFL 90"]])  # now above its old place
    query = watch_workbooks(spark, str(source), store, str(tmp_path / "c"))
    query.awaitTermination()
    assert query.lastProgress["numInputRows"] == 1
    assert {r.name_eng: r.name_kor for r in store.university().collect()} == {"A": "a2", "B": "b"}
    own = {r.name_eng: r.id for r in store.university().collect()}["A"]
    exams = store.language_requirement().filter(F.col("university_id") == own).collect()
    assert [(r.exam_type, r.min_score) for r in exams] == [("TOEFL", 90.0)]
    again = watch_workbooks(spark, str(source), store, str(tmp_path / "c"))
    again.awaitTermination()
    assert again.lastProgress is None or again.lastProgress["numInputRows"] == 0
    assert [(r.file, r.inserted, r.updated) for r in store.stats().orderBy("batch").collect()] == [
        ("2024-1 list.xlsx", 2, 0), ("2024-1 list.xlsx", 0, 1),
    ]


def test_versions_are_logged_once_and_read_after_a_stop(tmp_path):
    source, log = tmp_path / "in", str(tmp_path / "log")
    (source / "deep").mkdir(parents=True)
    (source / "a.xlsx").write_bytes(b"1")
    (source / "deep" / "b.xlsx").write_bytes(b"22")
    (source / "c.txt").write_bytes(b"3")
    options = {"path": str(source), "log": log, "pattern": "*.xlsx,*.xls", "filesPerBatch": "1", "secondsBetween": "0"}
    reader = FileVersionReader(options)
    assert reader.initialOffset() == {"entry": 0}
    assert [reader.latestOffset()["entry"] for _ in range(3)] == [1, 2, 2]
    # the stream stops before it has read the second entry
    reader = FileVersionReader(options)
    assert reader.latestOffset() == {"entry": 2}
    os.utime(source / "a.xlsx", ns=(1, 10**18))
    assert reader.latestOffset() == {"entry": 3}
    entries = [v for n in VersionLog(log).numbers() for v in VersionLog(log).read(n)]
    assert [os.path.basename(v[0]) for v in entries] == ["a.xlsx", "b.xlsx", "a.xlsx"] or len(entries) == 3
    groups = reader.partitions({"entry": 1}, {"entry": 3})
    found = [b.to_pylist()[0] for g in groups for b in reader.read(g)]
    assert sorted((os.path.basename(f["path"]), f["content"]) for f in found) == sorted(
        {(os.path.basename(v[0]), (source / os.path.relpath(v[0], source)).read_bytes()) for v in entries[1:]}
    )
    (source / "a.xlsx").unlink()
    gone = [b.to_pylist()[0] for g in reader.partitions({"entry": 2}, {"entry": 3}) for b in reader.read(g)]
    assert [f["content"] for f in gone] == [None]


def test_a_continuous_stream_takes_so_many_files_at_a_time(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(3):
        write_workbook(source / f"2024-1 {i}.xlsx", [HEADER, ["미국", f"k{i}", f"E{i}", None]])
    store = CatalogueStore(spark, str(tmp_path / "store"), stats=False)
    query = watch_workbooks(spark, str(source), store, str(tmp_path / "c"), files_per_batch=1, continuous=True)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.name_eng for r in store.university().collect()) == ["E0", "E1", "E2"]
    assert len(store._commits(store._folder())) == 3


def test_a_vanished_file_is_set_aside(spark, tmp_path):
    store = CatalogueStore(spark, str(tmp_path / "store"), stats=False)
    files = spark.createDataFrame([("2024-1 x.xlsx", 1, None)], "file string, version long, content binary")
    merge_files(files, 0, store)
    assert [(r.file, r.attempt) for r in store.quarantine().collect()] == [("2024-1 x.xlsx", 1)]


# Lookups by id.


def test_a_lookup_by_id_skips_row_groups(spark, tmp_path):
    rows = [row(f"u{i}", row_idx=i, language_requirement="TOEFL 80" if i % 2 else "HSK 5급") for i in range(4000)]
    entities = M.derive_entities(spark.createDataFrame([tuple({"file": "f", "semester": "s", **r}.get(c) for c in _columns()) for r in rows], SCHEMA))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        full_load(entities, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    requirements = read_tables(spark, str(tmp_path))[1]
    assert requirements.rdd.getNumPartitions() >= 1 and requirements.count() == 4000

    def rows_read(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        return plan.collectLeaves().apply(0).metrics().get("numOutputRows").get().value()

    one = requirements.filter(F.col("university_id") == 1234)
    assert one.count() == 1 and 0 < rows_read(one) <= 4000 / 4
    assert rows_read(requirements.filter(F.col("university_id") == 10**12)) == 0


def _columns():
    from test_merge import COLUMNS

    return COLUMNS


def test_large_workbooks_are_set_aside(spark, tmp_path):
    from sheetloom.sources.workbook import read_rows

    write_workbook(tmp_path / "a.xlsx", [HEADER, ["미국", "a", "A", None]])
    rows = read_rows(spark, str(tmp_path), max_bytes=10).collect()
    assert [(r.file, r.row_idx) for r in rows] == [("a.xlsx", None)] and rows[0].error.startswith("too large")
    run = ingest_workbooks(spark, str(tmp_path))
    assert run.bad_files.count() == 0
    assert [tuple(r) for r in run.counts.collect()] == [("a.xlsx", 1, 1, 1)]


def test_rows_keep_gaps_and_order(spark, tmp_path):
    from sheetloom.sources.workbook import read_rows

    write_workbook(tmp_path / "a.xlsx", [["a", None, "c"], [], [None, "x"]])
    rows = {r.row_idx: r["values"] for r in read_rows(spark, str(tmp_path)).collect()}
    assert rows == {0: ["a", None, "c"], 2: [None, "x"]}
