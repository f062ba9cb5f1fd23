"""From sheet rows to a wide listing.

A grid holds the rows of any number of sheets, each with its cells from the first
column on: ``file string, row_idx long, values array<string>``.  Header detection, the
header map and the choice of columns are narrow steps on these arrays; a file's layout,
a small record, is all that its rows are joined with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions.fields import base_name, file_semester
from sheetloom.functions.text import contains_any, strip

# Rows of one file are worked on in blocks of this many, so that a file with a
# large share of all rows is spread over many tasks.
BLOCK_ROWS = 65536
HEADER_SEARCH_ROWS = 10


def row_block(row: Column | str, size: int = BLOCK_ROWS) -> Column:
    return F.floor(F.col(row) / size) if isinstance(row, str) else F.floor(row / size)


def as_rows(grid: DataFrame) -> DataFrame:
    """A grid, also from its long form ``file, row_idx, col_idx, value``, which is shuffled by row."""
    if "values" in grid.columns:
        return grid
    rows = grid.groupBy("file", "row_idx").agg(
        F.map_from_entries(F.collect_list(F.struct("col_idx", "value"))).alias("cells"), F.max("col_idx").alias("last")
    )
    cells = F.transform(F.sequence(F.lit(0), "last"), lambda i: F.try_element_at("cells", i))
    return rows.select("file", "row_idx", cells.alias("values"))


def top_rows(grid: DataFrame) -> DataFrame:
    """The rows in which a header is looked for.

    A staged grid is partitioned by the flag ``top``, so only these rows are
    read from it.
    """
    top = grid.filter(F.col("row_idx") < HEADER_SEARCH_ROWS)
    return top.filter("top").drop("top") if "top" in grid.columns else as_rows(top)


def _beside(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Rows with their file's record, nulls where it has none.

    Staged rows are small on disk and many times larger in memory, so they must not be
    taken for the side to broadcast; of a left join only the records can be.  Filters on
    them have to let nulls through to stay behind it (``coalesce``), or Spark makes it an
    inner join.
    """
    return rows.join(records, "file", "left")


def header_rows(
    grid: DataFrame, synonyms: list[tuple[str, str]] = V.HEADER_SYNONYMS
) -> DataFrame:
    """Per file the first of its first ten rows that holds a known header."""
    texts = F.filter("values", lambda v: strip(v) != "")
    upper = F.transform(texts, lambda v: F.replace(F.upper(v), F.lit("\n"), F.lit(" ")))
    words = [synonym.upper() for synonym, _ in synonyms]
    rows = top_rows(grid).select("file", "row_idx", F.array_join(upper, " ").alias("row_text"))
    return (
        rows.filter(contains_any(F.col("row_text"), words))
        .groupBy("file")
        .agg(F.min("row_idx").alias("header_row"))
    )


def files_without_header(grid: DataFrame, headers: DataFrame) -> DataFrame:
    """Files to set aside, with the reason."""
    return (
        grid.select("file")
        .distinct()
        .join(headers, "file", "left_anti")
        .withColumn("reason", F.lit("no header row"))
    )


def header_text(value: Column, col_idx: Column) -> Column:
    """S7."""
    text = F.nullif(F.replace(strip(value), F.lit("\n"), F.lit(" ")), F.lit(""))
    return F.coalesce(text, F.concat(F.lit("Unnamed_"), col_idx.cast("string")))


def canonical_name(
    header: Column, synonyms: list[tuple[str, str]] = V.HEADER_SYNONYMS
) -> Column:
    """The exact synonym, else the longest one inside the header, else the header.

    Ties between equally long synonyms go to the one listed first.  Being one
    CASE expression it needs neither a join nor a window.
    """
    exact = F.create_map(*[F.lit(x) for pair in synonyms for x in pair])
    by_length = sorted(synonyms, key=lambda pair: -len(pair[0]))
    inside = F.when(header.contains(by_length[0][0]), by_length[0][1])
    for synonym, target in by_length[1:]:
        inside = inside.when(header.contains(synonym), target)
    return F.coalesce(F.try_element_at(exact, header), inside, header)


def header_map(
    grid: DataFrame, headers: DataFrame, synonyms: list[tuple[str, str]] = V.HEADER_SYNONYMS
) -> DataFrame:
    """``file, header_row, col_idx, header, canonical, column``.

    ``column`` is the canonical name with a suffix from its second use on.
    """
    cells = (
        _beside(top_rows(grid), headers)
        .filter(F.coalesce(F.col("row_idx") == F.col("header_row"), F.lit(False)))
        .select("file", "header_row", F.posexplode("values").alias("col_idx", "value"))
        .withColumn("header", header_text(F.col("value"), F.col("col_idx")))
        .withColumn("canonical", canonical_name(F.col("header"), synonyms))
    )
    order = Window.partitionBy("file", "canonical").orderBy("col_idx")
    nth = F.row_number().over(order) - 1
    return cells.select(
        "file",
        "header_row",
        "col_idx",
        "header",
        "canonical",
        F.when(nth == 0, F.col("canonical"))
        .otherwise(F.concat_ws("_", "canonical", nth.cast("string")))
        .alias("column"),
    )


def layouts(mapped: DataFrame, columns: list[str]) -> DataFrame:
    """Per file its header row, ``places``, the column number of each canonical column, and ``present``, those it has."""
    known = F.when(F.col("column").isin(columns), F.struct("column", "col_idx"))
    found = mapped.groupBy("file").agg(
        F.first("header_row").alias("header_row"), F.map_from_entries(F.collect_list(known)).alias("at")
    )
    places = F.array(*[F.try_element_at("at", F.lit(c)) for c in columns])
    return found.select("file", "header_row", places.alias("places"), F.map_keys("at").alias("present"))


def grid_to_table(
    grid: DataFrame, mapped: DataFrame, columns: list[str] = V.CANONICAL_COLUMNS, others: bool = False
) -> DataFrame:
    """One row per body row, one string column per canonical name.

    Columns a file does not have are null, and ``present`` lists those it has.
    With ``others`` the values of all remaining columns are kept by column number.
    Rows take their values by their file's layout, which is broadcast where its size
    allows; beyond that Spark splits the rows of a long file.
    """
    below = F.coalesce(F.col("row_idx") > F.col("header_row"), F.lit(False))
    rows = _beside(as_rows(grid), layouts(mapped, columns)).filter(below)
    place = F.col("places")
    values = [F.when(place[i].isNotNull(), F.get("values", place[i])).alias(c) for i, c in enumerate(columns)]
    numbered = F.transform("values", lambda v, i: F.struct(i.alias("col_idx"), v.alias("value")))
    left_over = F.filter(numbered, lambda o: ~F.coalesce(F.array_contains("places", o["col_idx"]), F.lit(False)))
    return rows.select("file", "row_idx", *values, "present", *([left_over.alias("others")] if others else []))


def inject_metadata(listing: DataFrame) -> DataFrame:
    """File name, semester and round, where the sheet has no such column.

    Presence is decided per column: a null cell of a present column stays null.
    """
    own = F.array_contains("present", "semester")
    return listing.withColumns(
        {
            "filename": base_name("file"),
            "semester": F.when(own, F.col("semester")).otherwise(file_semester("file")),
            "recruitment_round": F.lit(V.UNKNOWN),
        }
    )


def latest_file(df: DataFrame, file: str = "file") -> DataFrame:
    """Only the rows of the last file by name."""
    return df.filter(F.col(file) == df.agg(F.max(file)).scalar())


def first_files(df: DataFrame, n: int = 3, file: str = "file") -> DataFrame:
    """Only the rows of the first n files by name."""
    chosen = df.select(file).distinct().orderBy(file).limit(n)
    return df.join(chosen, file, "left_semi")


def header_audit(
    mapped: DataFrame, required: list[str] = V.REQUIRED_COLUMNS
) -> DataFrame:
    """Per file its columns in sheet order and the required ones it lacks."""
    columns = F.array_sort(F.collect_list(F.struct("col_idx", "column")))["column"]
    return mapped.groupBy("file").agg(columns.alias("columns")).select(
        "file",
        "columns",
        F.array_except(F.array(*[F.lit(c) for c in required]), "columns").alias("missing"),
    )
