"""Filling the region of a listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions.fields import base_name, field
from sheetloom.operators.grid import top_rows

SALTS = 32
REFERENCE_FILES = r"^202[45].*\.xlsx$"


def known_region(nation: Column, pairs: list[tuple[str, str]] = V.NATION_REGIONS) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in pairs for x in pair]), nation)


def fill_region(df: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Look up the region of rows that are unclassified.

    Without a table the fixed nation list is used as an expression; with one, a
    join in which a nation counts once (the last region by name) and only rows that
    need a region have a key.  A salt spreads the rows of a common nation, and those
    without a key, should the table outgrow a broadcast.
    """
    own = df.withColumn("region", field("region", V.UNCLASSIFIED))
    open_region = F.col("region") == V.UNCLASSIFIED
    if regions is None:
        known = known_region(field("nation"))
        return own.withColumn(
            "region", F.when(open_region, F.coalesce(known, "region")).otherwise(F.col("region"))
        )
    wanted = F.when(open_region, field("nation"))
    found = join_regions(own, regions.groupBy("nation").agg(F.max("region").alias("region")), wanted)
    return found.withColumn("region", F.coalesce("_region", "region")).drop("_region")


def join_regions(rows: DataFrame, regions: DataFrame, nation: Column) -> DataFrame:
    """``rows`` with ``_region``, looked up by an expression; the salted side is the lookup."""
    salt = F.pmod(F.hash(*[c for c in ("file", "row_idx", "id") if c in rows.columns]), F.lit(SALTS))
    lookup = regions.select(
        F.col("nation").alias("_nation"),
        F.col("region").alias("_region"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
    )
    keyed = rows.withColumns({"_nation": nation, "_salt": salt})
    return keyed.join(lookup, ["_nation", "_salt"], "left").drop("_nation", "_salt")


def is_reference_file(grid: DataFrame, bad: DataFrame | None = None) -> Column:
    """The file is the last one whose name marks it as a reference, ``bad`` files apart.

    The name is found by a scalar subquery, whose result Spark pushes into the
    scan as a plain file filter.
    """
    named = top_rows(grid).filter(base_name("file").rlike(REFERENCE_FILES))
    if bad is not None:
        named = named.join(bad.select("file"), "file", "left_anti")
    return F.col("file") == named.agg(F.max("file")).scalar()


def reference_regions(listing: DataFrame) -> DataFrame:
    """Nation -> region of one file's rows; the last row wins."""
    return (
        listing.dropna(subset=["nation", "region"])
        .groupBy("nation")
        .agg(F.max_by("region", "row_idx").alias("region"))
    )


def backfill_region(listing: DataFrame, regions: DataFrame) -> DataFrame:
    """2023 files without a region column take it from the reference file.

    ``region_key`` holds the nation of the rows that were looked up, so that a store
    can look again once it knows more.  Should the lookup outgrow a broadcast, the
    salt spreads the rows of a common nation, and those that need no lookup, over
    many tasks.
    """
    needs = (
        base_name("file").contains("2023")
        & ~F.array_contains("present", "region")
        & F.array_contains("present", "nation")
    )
    return join_regions(listing, regions, F.when(needs, F.col("nation"))).select(
        *[c for c in listing.columns if c != "region"],
        F.when(needs, F.coalesce("_region", F.lit(V.UNKNOWN)))
        .otherwise(F.col("region"))
        .alias("region"),
        F.when(needs, F.coalesce("nation", F.lit(""))).alias("region_key"),
    ).select(*listing.columns, "region_key")
