"""Upserts, ids, statistics and the incremental load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetloom.operators import merge as M
from sheetloom.operators import search as S
from sheetloom.plans import checks as C
from sheetloom.plans import ingest as I
from sheetloom.plans.inputs import derived, derived_sql
from sheetloom.plans.merge_checks import VALID, entity_select, merged_ctes
from sheetloom.plans.registry import CHECKS, query
from sheetloom.session import run_dir
from sheetloom.sources.sinks import read_tables
from sheetloom.streaming.incremental import CatalogueStore, start_incremental

LISTING = derived_sql("d_listing")
REGIONS = f"({derived_sql('d_region_map')})"
ENTITIES = f"entities AS ({entity_select(f'({LISTING})', REGIONS)})"
MERGED = f"WITH {ENTITIES}, {merged_ctes('entities')}"


def entities(spark: SparkSession, sf: str) -> DataFrame:
    return M.derive_entities(derived(spark, sf, "d_listing"), derived(spark, sf, "d_region_map"))


def valid_entities(spark: SparkSession, sf: str) -> DataFrame:
    return M.split_valid(entities(spark, sf))[0]


@query("entity_rows", f"WITH {ENTITIES} SELECT * FROM entities")
def entity_rows(spark: SparkSession, sf: str) -> DataFrame:
    return entities(spark, sf)


@query("upsert_latest", f"{MERGED} SELECT * FROM university")
def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    return I.merged_university(entities(spark, sf))


@query(
    "rejected_entities",
    f"""{MERGED}, winners AS (SELECT name_eng, nation, file, row_idx FROM winner)
        SELECT * FROM winners w WHERE NOT EXISTS (
            SELECT 1 FROM accumulated a WHERE a.name_eng = w.name_eng AND a.nation = w.nation)""",
)
def rejected_entities(spark: SparkSession, sf: str) -> DataFrame:
    return M.rejected_entities(M.collapse(valid_entities(spark, sf)))


@query("semester_accumulate", f"{MERGED} SELECT name_eng, nation, semester FROM accumulated")
def semester_accumulate(spark: SparkSession, sf: str) -> DataFrame:
    sets = valid_entities(spark, sf).groupBy(*M.KEY).agg(F.collect_set("semester").alias("semesters"))
    listed = sets.select(*M.KEY, M.semester_list("semesters").alias("semester"))
    return listed.filter(F.col("semester").isNotNull())


@query("surrogate_ids", f"{MERGED} SELECT id, name_eng, nation FROM firsts")
def surrogate_ids(spark: SparkSession, sf: str) -> DataFrame:
    return M.assign_ids(M.first_positions(valid_entities(spark, sf))).select("id", *M.KEY)


@query("child_replace", f"{MERGED} SELECT * FROM requirement")
def child_replace(spark: SparkSession, sf: str) -> DataFrame:
    return I.full_load(entities(spark, sf))[1]


@query(
    "load_stats",
    f"""{MERGED}, {C.requirement_ctes('SELECT row_idx AS id, language_score AS text, region FROM entities', prefix='a_')},
        seen AS (SELECT name_eng, nation, min(file) AS file FROM valid GROUP BY name_eng, nation),
        perfile AS (SELECT file, count(*) FILTER (WHERE {VALID}) AS valid, count(*) FILTER (WHERE NOT ({VALID})) AS skipped
            FROM entities GROUP BY file),
        ins AS (SELECT file, count(*) AS n FROM seen GROUP BY file),
        reqs AS (SELECT v.file, count(*) AS n FROM valid v JOIN a_req r ON r.id = v.row_idx GROUP BY v.file)
        SELECT p.file, coalesce(i.n, 0) AS inserted, p.valid - coalesce(i.n, 0) AS updated, p.skipped, coalesce(r.n, 0) AS language_reqs
        FROM perfile p LEFT JOIN ins i USING (file) LEFT JOIN reqs r USING (file)""",
)
def load_stats(spark: SparkSession, sf: str) -> DataFrame:
    return M.load_stats(entities(spark, sf))


_LATER = "'1998-2 list.xlsx'"


@query(
    "existing_match",
    f"""WITH {ENTITIES}, valid AS (SELECT * FROM entities WHERE {VALID})
        SELECT DISTINCT name_eng, nation FROM valid n WHERE file >= {_LATER} AND NOT EXISTS (
            SELECT 1 FROM valid o WHERE o.file < {_LATER} AND o.name_eng = n.name_eng AND o.nation = n.nation)""",
)
def existing_match(spark: SparkSession, sf: str) -> DataFrame:
    valid = valid_entities(spark, sf)
    stored = valid.filter(f"file < {_LATER}").select(*M.KEY).distinct()
    arrived = valid.filter(f"file >= {_LATER}").select(*M.KEY).distinct()
    return M.new_keys(arrived, stored)


@query(
    "orphan_check",
    f"""{MERGED} SELECT r.university_id, r.exam_type FROM requirement r
        WHERE NOT EXISTS (SELECT 1 FROM university u WHERE u.id = r.university_id AND u.is_exchange)""",
)
def orphan_check(spark: SparkSession, sf: str) -> DataFrame:
    """Which requirements would be left alone if only exchange places stayed."""
    university, requirements = I.full_load(entities(spark, sf))
    return S.orphans(requirements, university.filter("is_exchange")).select("university_id", "exam_type")


@query(
    "stored_search",
    f"""{MERGED} SELECT id, name_eng, nation, semester FROM university u WHERE EXISTS (
        SELECT 1 FROM requirement r WHERE r.university_id = u.id AND r.exam_type = 'TOEFL' AND r.min_score <= 80 AND r.is_available)""",
)
def stored_search(spark: SparkSession, sf: str) -> DataFrame:
    """A search that reads the stored tables: of the requirements only the exam's row groups."""
    path = run_dir(spark, "tables")
    I.full_load(entities(spark, sf), path)
    found = S.search_by_score(*read_tables(spark, path), "TOEFL", 80.0, available_only=True)
    return found.select("id", "name_eng", "nation", "semester")


@query(
    "stored_lookup",
    f"""{MERGED} SELECT u.name_eng, u.nation, r.exam_type, r.min_score, r.level_code, r.is_available
        FROM university u JOIN requirement r ON r.university_id = u.id WHERE u.id = (SELECT max(id) FROM university WHERE id % 7 = 3)""",
)
def stored_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """One university and its requirements from the written tables, by id."""
    path = run_dir(spark, "tables")
    I.full_load(entities(spark, sf), path)
    university, requirements = read_tables(spark, path)
    wanted = university.filter("id % 7 = 3").agg(F.max("id")).first()[0] or -1
    own = university.filter(F.col("id") == wanted).select(F.col("id").alias("university_id"), *M.KEY)
    found = S.requirements_of(requirements, wanted).drop("id").join(own, "university_id")
    return found.select(*M.KEY, "exam_type", "min_score", "level_code", "is_available")


@query(
    "incremental_upsert",
    f"{MERGED} SELECT * EXCLUDE (id) FROM university",
)
def incremental_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The listing arrives as files, in micro-batches that are merged one by one.

    Ids depend on the order of arrival and are left out.
    """
    base = run_dir(spark, "incremental")
    listing, regions = derived(spark, sf, "d_listing"), derived(spark, sf, "d_region_map")
    listing.repartition(3, "row_idx").write.parquet(f"{base}/arrivals")
    stream = (
        spark.readStream.schema(listing.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{base}/arrivals")
    )
    store = CatalogueStore(spark, f"{base}/store", stats=False)
    start_incremental(
        stream, lambda df: M.derive_entities(df, regions), store, f"{base}/checkpoint"
    ).awaitTermination()
    return store.university().drop("id")


_BATCHES = ["1994-2 list.xlsx", "1996-2 list.xlsx"]
_BATCH = f"CASE WHEN file < '{_BATCHES[0]}' THEN 0 WHEN file < '{_BATCHES[1]}' THEN 1 ELSE 2 END"


def store(spark: SparkSession, name: str, **options) -> CatalogueStore:
    return CatalogueStore(spark, run_dir(spark, name), **({"stats": False} | options))


@query("incremental_stats", CHECKS["load_stats"])
def incremental_stats(spark: SparkSession, sf: str) -> DataFrame:
    """M5: statistics of three batches of files, one of which comes twice."""
    rows, own = entities(spark, sf), store(spark, "stats-store", stats=True)
    for batch in (0, 1, 1, 2):
        own.apply(rows.filter(F.expr(_BATCH) == batch), batch)
    return own.stats().select("file", "inserted", "updated", "skipped", "language_reqs")


REMOVED = f"""WITH {ENTITIES},
    last_removal AS (SELECT * FROM (SELECT name_eng, nation, file, row_idx, row_number() OVER (
            PARTITION BY name_eng, nation ORDER BY file DESC, row_idx DESC) AS rn
        FROM entities WHERE {VALID} AND row_idx % 97 = 0) g WHERE rn = 1),
    remaining AS (SELECT e.* FROM entities e LEFT JOIN last_removal g ON g.name_eng = e.name_eng AND g.nation = e.nation
        WHERE g.file IS NULL OR e.file > g.file OR (e.file = g.file AND e.row_idx > g.row_idx)),
    {merged_ctes('remaining')}"""


def removals(spark: SparkSession, sf: str) -> DataFrame:
    """Entities that are removed at the place of some of their rows."""
    return valid_entities(spark, sf).filter("row_idx % 97 = 0").select(*M.KEY, "file", "row_idx")


@query("delete_cascade_load", f"{REMOVED} SELECT * FROM university")
def delete_cascade_load(spark: SparkSession, sf: str) -> DataFrame:
    """J9 in one load."""
    return I.merged_university(entities(spark, sf), removals(spark, sf))


@query(
    "delete_cascade",
    f"""{REMOVED} SELECT u.name_eng, u.nation, u.semester, u.badge, r.exam_type, r.min_score, r.is_available
        FROM university u LEFT JOIN requirement r ON r.university_id = u.id""",
)
def delete_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """J9 incrementally: the removals come after some and before other rows that they concern."""
    rows, own = entities(spark, sf), store(spark, "delete-store")
    for batch in range(3):
        own.apply(rows.filter(F.col("row_idx") % 3 == batch), batch, deleted=removals(spark, sf) if batch == 1 else None)
    found = own.university().select(F.col("id").alias("university_id"), *M.KEY, "semester", "badge")
    children = own.language_requirement().select("university_id", "exam_type", "min_score", "is_available")
    return found.join(children, "university_id", "left").drop("university_id")


_FIRST = f"first_rows AS (SELECT * FROM entities WHERE file < '{_BATCHES[0]}')"


@query(
    "full_refresh",
    f"""SELECT 'before' AS phase, name_eng, nation, semester, badge FROM (
            WITH {ENTITIES}, {_FIRST}, {merged_ctes('first_rows')} SELECT * FROM university) u
        UNION ALL SELECT 'after', name_eng, nation, semester, badge FROM ({MERGED} SELECT * FROM university) u""",
)
def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A table that was opened before the refresh, and one after it."""
    rows, own = entities(spark, sf), store(spark, "refresh-store")
    own.apply(rows.filter(F.expr(_BATCH) == 0), 0)
    before = own.university()
    own.refresh(rows)
    phases = [t.select(F.lit(p).alias("phase"), *M.KEY, "semester", "badge") for p, t in (("before", before), ("after", own.university()))]
    return phases[0].unionByName(phases[1])


@query("stable_ids", f"{MERGED} SELECT name_eng, nation, true AS same, CAST(1 AS BIGINT) AS holders FROM university")
def stable_ids(spark: SparkSession, sf: str) -> DataFrame:
    """M6: ids that follow from the keys, from one load and from batches in another order."""
    rows = entities(spark, sf)
    one, many = (store(spark, f"ids-{n}", ids="hash") for n in ("one", "many"))
    one.apply(rows, 0)
    for batch in (2, 0, 1):
        many.apply(rows.filter(F.col("row_idx") % 3 == batch), batch)
    left, right = (s.university().select(*M.KEY, F.col("id").alias(n)) for s, n in ((one, "id"), (many, "other")))
    holders = F.count("*").over(Window.partitionBy("id"))
    return left.join(right, M.KEY, "full").select(*M.KEY, F.col("id").eqNullSafe(F.col("other")).alias("same"), holders.alias("holders"))
