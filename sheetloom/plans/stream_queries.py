"""Folders and streams of workbooks: listing, whole runs, files set aside or written anew (S2, S13, S14, ST1)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.plans import ingest as I
from sheetloom.plans.grid_queries import entities_of
from sheetloom.plans.inputs import derived, derived_sql, sheet_books, sheet_cells, sheet_cells_sql
from sheetloom.plans.merge_checks import merged_ctes
from sheetloom.plans.registry import CHECKS, query
from sheetloom.session import run_dir
from sheetloom.sources.changes import open_folder
from sheetloom.sources.staging import stage
from sheetloom.sources.workbook import list_workbooks
from sheetloom.streaming.incremental import CatalogueStore, start_merging

_BROKEN = "BadZipFile: File is not a zip file"
#: Which workbooks arrive in each of three batches, and which of them are cut short.
_ARRIVALS = [("true", "f % 5 = 1"), ("f % 5 = 1", "f % 2 = 1"), ("f % 5 = 1 OR layout = 6", "f % 5 = 1 AND f % 3 = 1")]


@query(
    "stream_quarantine",
    f"""WITH files AS (SELECT DISTINCT file, f, layout FROM ({derived_sql('d_sheet')}) s),
        tries AS ({' UNION ALL '.join(
            f"SELECT file, CAST({i} AS BIGINT) AS batch, CASE WHEN {broken} THEN '{_BROKEN}' WHEN layout = 6 THEN 'no header row' END AS reason "
            f"FROM files WHERE {arrives}" for i, (arrives, broken) in enumerate(_ARRIVALS))}),
        good AS (SELECT file, max(batch) AS batch FROM tries WHERE reason IS NULL GROUP BY file),
        open AS (SELECT t.* FROM tries t LEFT JOIN good g ON g.file = t.file WHERE t.batch > coalesce(g.batch, -1))
        SELECT file, arg_max(reason, batch) AS reason, max(batch) AS batch, count(*) AS attempt FROM open GROUP BY file""",
)
def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Workbooks arrive in three batches, some cut short, some without a header, some mended later."""
    base = run_dir(spark, "quarantine")
    names = derived(spark, sf, "d_sheet").select("file", "f", "layout").distinct()
    books = stage(sheet_books(sheet_cells(spark, sf)).join(names, "file"), "books")
    store = CatalogueStore(spark, f"{base}/store")
    for version, (arrives, broken) in enumerate(_ARRIVALS):
        content = F.when(F.expr(broken), F.substring("content", 1, 20)).otherwise(F.col("content"))
        arrived = books.filter(arrives).select("file", F.lit(version).cast("long").alias("version"), content.alias("content"))
        arrived.write.mode("append").parquet(f"{base}/arrivals")
        stream = spark.readStream.schema(arrived.schema).parquet(f"{base}/arrivals")
        start_merging(stream, lambda df, batch: I.merge_files(df, batch, store), f"{base}/checkpoint").awaitTermination()
    return store.quarantine()


#: The second version of a sheet: rows are missing, others have moved up, and remarks differ.
_REWRITTEN = "file LIKE '2022%' OR file LIKE '2023%'"
_SECOND = "NOT row_idx BETWEEN 18 AND 20"
_MOVED = "CAST(CASE WHEN row_idx > 20 THEN row_idx - 3 ELSE row_idx END AS BIGINT)"
_CHANGED = "CASE WHEN col_idx = 5 AND row_idx > 3 THEN value || ' again' ELSE value END"
_BOTH = f"""WITH once AS ({sheet_cells_sql()}) SELECT * FROM once UNION ALL
    SELECT concat(file, ' 2'), {_MOVED}, col_idx, {_CHANGED} FROM once WHERE ({_REWRITTEN}) AND {_SECOND}"""


def write_books(books: DataFrame, folder: str) -> None:
    """``file, content`` as files of a folder."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        files.create_dir(path, recursive=True)
        for batch in batches:
            for name, content in zip(batch["file"].to_pylist(), batch["content"].to_pylist()):
                with files.open_output_stream(f"{path}/{name}") as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays([batch["file"]], names=["file"])

    books.mapInArrow(write, "file string").count()


def folder_of_books(spark: SparkSession, sf: str, name: str) -> str:
    """The sheets as workbooks in a folder of their own, with lock files beside some of them."""
    folder = f"{run_dir(spark, name)}/in"
    books = sheet_books(sheet_cells(spark, sf))
    locks = books.filter("file LIKE '2024%'").withColumn("file", F.concat(F.lit("~$"), "file"))
    write_books(books.unionByName(locks), folder)
    return folder


@query("folder_listing", f"SELECT DISTINCT file FROM ({derived_sql('d_sheet')}) s")
def folder_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The workbooks of a folder, lock files left out."""
    return list_workbooks(spark, folder_of_books(spark, sf, "listing")).select("file")


@query("folder_run", CHECKS["stage_counts"])
def folder_run(spark: SparkSession, sf: str) -> DataFrame:
    """A run over a folder, up to the load: what each step has left of each file."""
    return I.ingest_workbooks(spark, folder_of_books(spark, sf, "folder")).counts


@query(
    "rewritten_file",
    f"""WITH {entities_of(_BOTH)},
        placed AS (SELECT * REPLACE (CASE WHEN file LIKE '% 2' THEN left(file, length(file) - 2) ELSE file END AS file,
            CASE WHEN file LIKE '% 2' THEN row_idx + 1000000 ELSE row_idx END AS row_idx) FROM entities),
        {merged_ctes('placed')} SELECT * EXCLUDE (id) FROM university""",
)
def rewritten_file(spark: SparkSession, sf: str) -> DataFrame:
    """Some workbooks are written anew between two runs of the stream; a third run finds nothing."""
    base = run_dir(spark, "rewritten")
    cells = sheet_cells(spark, sf)
    second = cells.filter(_REWRITTEN).filter(_SECOND).select(
        "file", F.expr(_MOVED).alias("row_idx"), "col_idx", F.expr(_CHANGED).alias("value")
    )
    store = CatalogueStore(spark, f"{base}/store")
    for version in (cells, second, None):
        if version is not None:
            write_books(sheet_books(version), f"{base}/in")
        I.watch_workbooks(spark, f"{base}/in", store, f"{base}/checkpoint").awaitTermination()
    return store.university().drop("id")
