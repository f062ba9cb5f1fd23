"""Upserting listings into the two tables.

The state of one entity is a small record that merges with any other record of
the same entity in any order: the latest row, the first position, the set of
semesters.  Batches, replays and single loads therefore share one aggregate,
and ``max_by`` combines on the map side, so a name that a third of all rows
carry is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions import fields as X
from sheetloom.functions.requirements import note_exclusions
from sheetloom.operators.ids import sequence_ids
from sheetloom.operators.regions import fill_region
from sheetloom.operators.requirements import (
    inline_requirements,
    mark_available,
    with_requirements,
)

KEY = ["name_eng", "nation"]
SEPARATOR = ", "
# the listing columns that are stored, directly or in derived form
_SOURCES = [
    c for c in V.CANONICAL_COLUMNS if c not in ("quota", "qualification", "available_semester")
]
ATTRIBUTES = [
    "region",
    "name_kor",
    "min_gpa",
    "significant_note",
    "remark",
    "available_majors",
    "website_url",
    "badge",
    "is_exchange",
    "is_visit",
    "has_review",
    "review_year",
    "language_score",
]
#: What a state keeps of the latest row: the stored attributes, and the nation by
#: which its region was looked up in a reference file.
KEPT = [*ATTRIBUTES, "region_key"]


def derive_entities(listing: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """The columns of an entity, one row per listing row."""
    present = set(listing.columns)
    values = listing.select(
        "file",
        "row_idx",
        *[X.field(c if c in present else F.lit(None).cast("string")).alias(c) for c in _SOURCES],
        *[c for c in ["region_key"] if c in present],
    )
    return fill_region(values, regions).select(
        "file",
        "row_idx",
        "name_kor",
        "name_eng",
        "nation",
        "region",
        "semester",
        F.coalesce(X.gpa_number("min_gpa"), F.lit(0.0)).alias("min_gpa"),
        "significant_note",
        X.join_remarks("remark", "remark_ref").alias("remark"),
        "available_majors",
        X.first_url("website_url").alias("website_url"),
        F.col("institution").alias("badge"),
        X.is_exchange("program_type").alias("is_exchange"),
        X.is_visit("program_type").alias("is_visit"),
        X.has_review("review_raw").alias("has_review"),
        X.review_year("review_raw").alias("review_year"),
        F.col("language_requirement").alias("language_score"),
        *[c for c in ["region_key"] if c in present],
    )


def has_keys() -> Column:
    """P3."""
    return F.col("name_kor").isNotNull() & F.col("name_eng").isNotNull() & F.col("nation").isNotNull()


def split_valid(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with all required keys, and the others."""
    return entities.filter(has_keys()), entities.filter(~has_keys())


def collapse(entities: DataFrame) -> DataFrame:
    """M1-M3: one state record per key from valid listing rows.

    The latest row wins with all its attributes, nulls included.
    """
    position = F.struct("file", "row_idx")
    kept = [c for c in KEPT if c in entities.columns]
    return entities.groupBy(*KEY).agg(
        F.min(position).alias("first_seen"),
        F.max(position).alias("last_seen"),
        F.max_by(F.struct(*kept), position).alias("latest"),
        F.collect_set("semester").alias("semesters"),
    )


def _position(rows: DataFrame) -> Column:
    return F.struct("file", "version", "row_idx") if "version" in rows.columns else F.struct("file", "row_idx")


def collapse_dated(entities: DataFrame) -> DataFrame:
    """The same with the last position of each semester, for stored state that may lose what lies before a removal.

    A first aggregate by key and semester combines before the shuffle, so the second
    has one row per key and term.
    """
    position = _position(entities)
    terms = entities.groupBy(*KEY, "semester").agg(
        F.min(position).alias("first_seen"),
        F.max(position).alias("last_seen"),
        F.max_by(F.struct(*[c for c in KEPT if c in entities.columns]), position).alias("latest"),
    )
    dated = F.when(F.col("semester").isNotNull(), F.struct("semester", F.col("last_seen").alias("seen")))
    return terms.groupBy(*KEY).agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.max_by("latest", "last_seen").alias("latest"),
        F.collect_list(dated).alias("semesters"),
    )


def tombstones(deleted: DataFrame) -> DataFrame:
    """State records of entities that are removed at a position."""
    if "version" not in deleted.columns:
        deleted = deleted.withColumn("version", F.lit(0).cast("long"))
    return deleted.groupBy(*KEY).agg(F.max(_position(deleted)).alias("removed"))


def without_removed(entities: DataFrame, deleted: DataFrame) -> DataFrame:
    """J9 in one load: the rows that no removal of their key follows."""
    dated = entities if "version" in entities.columns else entities.withColumn("version", F.lit(0).cast("long"))
    rows = dated.join(tombstones(deleted), KEY, "left")
    later = F.col("removed").isNull() | (_position(dated) > F.col("removed"))
    return rows.filter(later).select(*entities.columns)


def combine(states: DataFrame, drop_removed: bool = True, key: list[str] = KEY) -> DataFrame:
    """The same merge over dated state records, for example of several batches.

    Of a position that arrived again, the later ``batch`` holds.  What lies at or before
    the last removal goes: terms, and the row itself if no later one has come; the
    removal stays on record, so that rows arriving late don't undo it.
    """
    order = F.struct("last_seen", "batch") if "batch" in states.columns else F.struct("last_seen")
    order = F.when(F.col("last_seen").isNotNull(), order)
    extra = {"id": F.min, "batch": F.max}
    merged = states.groupBy(*key).agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.max_by("latest", order).alias("latest"),
        F.flatten(F.collect_list("semesters")).alias("_all"),
        *([F.max("removed").alias("removed")] if "removed" in states.columns else [F.first(F.lit(None)).alias("removed")]),
        *[f(c).alias(c) for c, f in extra.items() if c in states.columns],
    )
    last = lambda t: F.array_max(F.filter("_all", lambda s: s["semester"] == t)["seen"])
    terms = F.transform(F.array_distinct(F.col("_all.semester")), lambda t: F.struct(t.alias("semester"), last(t).alias("seen")))
    merged = merged.withColumn("semesters", terms).drop("_all")
    if not drop_removed or "removed" not in states.columns:
        return merged
    kept = F.col("removed").isNull() | (F.col("last_seen") > F.col("removed"))
    left = F.filter("semesters", lambda s: F.col("removed").isNull() | (s["seen"] > F.col("removed")))
    return merged.withColumns(
        {"semesters": left, "latest": F.when(kept, F.col("latest")), "last_seen": F.when(kept, F.col("last_seen"))}
    )


def semester_list(semesters: Column | str) -> Column:
    """M2/T5: all semesters, latest first; a single value stays as written."""
    values = F.col(semesters) if isinstance(semesters, str) else semesters
    parts = F.array_distinct(F.flatten(F.transform(values, lambda s: F.split(s, SEPARATOR))))
    listed = F.array_join(F.sort_array(parts, asc=False), SEPARATOR)
    return F.when(F.size(values) == 1, values[0]).when(F.size(values) > 1, listed)


def existing_keys(known: DataFrame, states: DataFrame) -> DataFrame:
    """The stored keys among those of a batch.

    A small batch is broadcast into the scan of the stored keys.
    """
    return known.select(*KEY).join(states.select(*KEY), KEY, "left_semi")


def new_keys(states: DataFrame, known: DataFrame) -> DataFrame:
    """States whose key is not yet stored."""
    return states.join(existing_keys(known, states), KEY, "left_anti")


def first_positions(entities: DataFrame) -> DataFrame:
    """Keys with the place where each first appears."""
    return entities.groupBy(*KEY).agg(F.min(F.struct("file", "row_idx")).alias("first_seen"))


def assign_ids(states: DataFrame, start: int = 0) -> DataFrame:
    """M6: ids by first appearance."""
    return sequence_ids(states, ["first_seen.file", "first_seen.row_idx"], "id", start)


def university_table(states: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The entity table; entities without any semester are rejected."""
    return states.select(
        "id",
        semester_list("semesters").alias("semester"),
        "nation",
        "name_eng",
        *[f"latest.{c}" for c in (*ATTRIBUTES, *keep)],
    ).filter(F.col("semester").isNotNull())


def rejected_entities(states: DataFrame) -> DataFrame:
    """Keys that no row gives a semester for, with their latest row."""
    return states.filter(F.size("semesters") == 0).select(*KEY, "last_seen.file", "last_seen.row_idx")


def requirement_table(university: DataFrame, waiver_mode: str = "legacy") -> DataFrame:
    """M4: requirements of the stored row of each entity.

    They follow from the latest row alone, so requirements of replaced rows
    vanish, also where the latest row is waived or blank.
    """
    parsed = with_requirements(
        university.select("id", "region", "language_score", "significant_note"),
        "language_score",
        "region",
        waiver_mode,
    ).withColumn("_excluded", note_exclusions("significant_note"))
    rows = inline_requirements(parsed, [F.col("id").alias("university_id"), "_excluded"])
    exams = F.array(*[F.lit(exam) for exam, _ in V.EXAM_GROUPS])
    return mark_available(rows, "_excluded").select(
        (F.col("university_id") * 100 + F.array_position(exams, F.col("exam_type"))).alias("id"),
        "university_id",
        "language_group",
        "exam_type",
        "min_score",
        "level_code",
        "is_available",
    )


def load_stats(entities: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """M5: inserted, updated, skipped and requirement rows per file.

    Requirements count for every processed row, before later rows replace them.
    """
    parsed = with_requirements(entities, "language_score", "region").select(
        "file", "row_idx", *KEY, has_keys().alias("valid"), F.size("requirements").alias("n_req")
    )
    per_file = parsed.groupBy("file").agg(
        F.count_if("valid").alias("valid"),
        F.count_if(~F.col("valid")).alias("skipped"),
        F.coalesce(F.sum(F.when(F.col("valid"), F.col("n_req"))), F.lit(0)).alias("language_reqs"),
    )
    firsts = entities.filter(has_keys()).groupBy(*KEY).agg(F.min("file").alias("file"))
    if known is not None:
        firsts = new_keys(firsts, known)
    inserted = firsts.groupBy("file").agg(F.count("*").alias("inserted"))
    return per_file.join(inserted, "file", "left").select(
        "file",
        F.coalesce("inserted", F.lit(0)).alias("inserted"),
        (F.col("valid") - F.coalesce("inserted", F.lit(0))).alias("updated"),
        "skipped",
        "language_reqs",
    )
