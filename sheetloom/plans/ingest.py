"""The whole run over a folder of workbooks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sheetloom import vocabulary as V
from sheetloom.functions.fields import collapse_whitespace
from sheetloom.operators import grid as G
from sheetloom.operators import merge as M
from sheetloom.operators.clean import clean_marked, clean_values, drop_empty_rows, drop_summary_rows, forward_fill
from sheetloom.operators.regions import backfill_region, is_reference_file, reference_regions
from sheetloom.operators.reports import stage_counts
from sheetloom.session import run_dir
from sheetloom.sources.sinks import csv_line, write_tables
from sheetloom.sources.staging import stage
from sheetloom.sources.workbook import decode_rows, read_rows, stream_workbooks
from sheetloom.streaming.incremental import CatalogueStore, start_merging, stream_id


@dataclass
class Ingested:
    """Results of one run; nothing is loaded until they are written.

    Steps that several results share are staged while the run is set up.
    """

    extracted: DataFrame
    cleaned: DataFrame
    entities: DataFrame
    bad_files: DataFrame
    reference: DataFrame
    #: Rows per file after each step.
    counts: DataFrame


def stage_grid(grid: DataFrame) -> DataFrame:
    """The grid as a table in which the rows that may be headers are a partition of their own."""
    return stage(G.as_rows(grid).withColumn("top", F.col("row_idx") < G.HEADER_SEARCH_ROWS), "grid", "top")


@dataclass
class Layout:
    """What is known of the files before their rows are put together; small and staged."""

    mapped: DataFrame
    reference: DataFrame
    bad: DataFrame | None


def read_layout(grid: DataFrame, bad: DataFrame | None = None) -> Layout:
    """Header map of all files but ``bad`` ones, and the rows of the reference file.

    Both are small; being written first, the joins with the rows are planned by
    their real size.  A file that isn't in the header map takes no part in anything.
    """
    headers = G.header_rows(grid)
    if bad is not None:
        headers = headers.join(bad.select("file"), "file", "left_anti")
    mapped = stage(G.header_map(grid, headers), "headers")
    wanted = is_reference_file(grid, bad)
    rows = G.grid_to_table(grid.filter(wanted), mapped.filter(wanted))
    reference = rows.select("file", "row_idx", "nation", "region").dropna()
    return Layout(mapped, stage(reference, "reference"), bad)


def assemble(grid: DataFrame, layout: Layout | None = None, others: bool = False) -> DataFrame:
    """S6-S10 and J2."""
    layout = layout or read_layout(grid)
    rows = G.grid_to_table(grid, layout.mapped, others=others)
    return backfill_region(rows, reference_regions(layout.reference))


def extract_listing(grid: DataFrame, layout: Layout | None = None) -> DataFrame:
    """S5 on top of the assembled rows."""
    return G.inject_metadata(assemble(grid, layout))


def ingest_grid(
    grid: DataFrame, nan_rule: bool = False, regions: DataFrame | None = None, unreadable: DataFrame | None = None
) -> Ingested:
    """Extract, clean and derive all files of a staged grid.

    A file without a header row, or named in ``unreadable``, goes to ``bad_files``;
    the others go on.  The extracted rows are written once, because filling reads
    them twice.
    """
    layout = read_layout(grid, unreadable)
    extracted = stage(extract_listing(grid, layout), "listing")
    marked = clean_marked(extracted, nan_rule)
    cleaned = marked.filter("kept").drop("kept")
    bad = G.files_without_header(grid, layout.mapped.select("file").distinct())
    if unreadable is not None:
        bad = bad.join(unreadable.select("file"), "file", "left_anti").unionByName(unreadable)
    entities = M.derive_entities(cleaned, regions)
    return Ingested(extracted, cleaned, entities, bad, layout.reference, stage_counts(marked))


def ingest_rows(rows: DataFrame) -> Ingested:
    """The same for the rows of decoded workbooks, staged or not, of which some may be unreadable.

    Nothing of a file that failed half-way is used.  Errors have no row number, so
    they are a partition of the staged grid of their own.
    """
    staged = rows if "top" in rows.columns else stage_grid(rows)
    errors = staged.filter(F.col("top").isNull()).select("file", F.col("error").alias("reason"))
    return ingest_grid(staged.filter(F.col("top").isNotNull()).drop("error"), unreadable=stage(errors, "unreadable"))


def ingest_workbooks(spark: SparkSession, source: str, latest_only: bool = False) -> Ingested:
    """Everything up to the load; loading is a step of the caller."""
    return ingest_rows(read_rows(spark, source, latest_only))


def watch_workbooks(
    spark: SparkSession, source: str, store: CatalogueStore, checkpoint: str, files_per_batch: int = 1000, continuous: bool = False
) -> StreamingQuery:
    """ST1 from a folder: workbooks that arrived, or were written anew, since the last run are merged.

    The store keeps the rows of reference files and fills missing regions when its
    tables are read, so that it doesn't matter which files share a batch.  Rows of a
    later version of a file come after those of an earlier one.  A file that cannot be
    read or has no header is set aside in the store's ``quarantine`` until a version of
    it can be read; the others go on.

    A run takes in what is there when it begins, as one batch.  A ``continuous`` one goes
    on until it is stopped and takes ``files_per_batch`` at a time.
    """
    log = f"{checkpoint.rstrip('/')}/versions"
    files = stream_workbooks(spark, source, log, files_per_batch if continuous else 0)
    return start_merging(files, lambda df, batch: merge_files(df, batch, store), checkpoint, continuous)


def merge_files(files: DataFrame, batch: int, store: CatalogueStore) -> None:
    """One micro-batch of ``file, version, content``: its workbooks to the tables, what cannot be read to the quarantine.

    Both sinks belong to one commit of the store.
    """
    writer = stream_id(files.sparkSession)
    rows = stage_grid(decode_rows(files))
    versions = stage(rows.select("file", "version").distinct(), "versions")
    run = ingest_rows(rows.drop("version"))
    store.apply(run.entities, batch, run.reference, versions=versions, files=versions, bad_files=run.bad_files, writer=writer)


def export_table(grid: DataFrame) -> DataFrame:
    """The cleaned listing without file metadata, canonical columns only, for one CSV table."""
    listing = stage(assemble(grid), "listing")
    filled = forward_fill(clean_values(listing), V.FILLED_COLUMNS)
    return drop_summary_rows(drop_empty_rows(filled)).select("file", "row_idx", *V.CANONICAL_COLUMNS)


def export_lines(grid: DataFrame) -> DataFrame:
    """``file, row_idx, line``: each file as CSV with all of its own columns.

    The header line of a file has ``row_idx`` -1.  Columns keep the order of the
    sheet, with repeated (suffixed) and unmapped ones; a region that was filled in is
    the last column.
    """
    layout = read_layout(grid)
    listing = stage(assemble(grid, layout, others=True), "listing")
    clean_other = F.transform(
        "others", lambda o: F.struct(o["col_idx"].alias("col_idx"), collapse_whitespace(o["value"]).alias("value"))
    )
    filled = forward_fill(clean_values(listing).withColumn("others", clean_other), V.FILLED_COLUMNS)
    rows = drop_summary_rows(drop_empty_rows(filled))
    columns = F.array_sort(F.collect_list(F.struct("col_idx", "column")))
    names = layout.mapped.groupBy("file").agg(columns.alias("columns"))
    own = F.create_map(*[x for c in V.CANONICAL_COLUMNS for x in (F.lit(c), F.col(c))])
    added = F.when(F.col("region_key").isNotNull(), F.array("region"))

    def value(column: Column) -> Column:
        other = F.filter("others", lambda o: o["col_idx"] == column["col_idx"])
        return F.coalesce(F.try_element_at("own", column["column"]), F.get(other, 0)["value"])

    body = rows.withColumn("own", own).join(names, "file", "left").select(
        "file", "row_idx", csv_line(F.concat(F.transform("columns", value), F.coalesce(added, F.array()))).alias("line")
    )
    with_region = listing.groupBy("file").agg(F.max(F.col("region_key").isNotNull()).alias("added"))
    extra = F.when(F.col("added"), F.array(F.lit("region"))).otherwise(F.array())
    head = names.join(with_region, "file", "left").select(
        "file", F.lit(-1).cast("long").alias("row_idx"), csv_line(F.concat("columns.column", extra)).alias("line")
    )
    return head.unionByName(body)


def merged_university(entities: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """The entity table of a full refresh, without what ``deleted`` removes.

    The listing is derived once: its states are staged, and ids are numbered on their
    keys alone, so that only those go through the checkpoint.
    """
    valid, _ = M.split_valid(entities)
    if deleted is not None:
        valid = M.without_removed(valid, stage(deleted, "deleted"))
    states = stage(M.collapse(valid), "states")
    ids = M.assign_ids(states.select(*M.KEY, "first_seen")).select(*M.KEY, "id")
    return M.university_table(states.join(ids, M.KEY))


def full_load(entities: DataFrame, path: str | None = None, deleted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Write both tables of a full refresh and read them back.

    Requirements are extracted from the stored entities: only the latest row
    of each entity is parsed.
    """
    path = path or run_dir(entities.sparkSession, "tables")
    return write_tables(merged_university(entities, deleted), M.requirement_table, path)
