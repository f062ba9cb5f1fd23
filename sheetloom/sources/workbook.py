"""Workbooks as rows or cells.

Spark lists and reads the files from any file system; a task turns the bytes of
one workbook at a time into Arrow batches of rows, or of single cells.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import lru_cache
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.functions.fields import FOLDER_MARK
from sheetloom.operators.grid import latest_file
from sheetloom.sources.changes import FORMAT, FileVersions

GRID_SCHEMA = "file string, row_idx long, col_idx int, value string, error string"
_ARROW_SCHEMA = pa.schema(
    [
        ("file", pa.string()),
        ("row_idx", pa.int64()),
        ("col_idx", pa.int32()),
        ("value", pa.string()),
        ("error", pa.string()),
    ]
)
ROW_SCHEMA = "file string, row_idx long, values array<string>, error string"
_ROW_ARROW = pa.schema([("file", pa.string()), ("row_idx", pa.int64()), ("values", pa.list_(pa.string())), ("error", pa.string())])
#: Larger workbooks are set aside unread: a task holds the bytes of one.
MAX_BYTES = 1 << 30
_NAMES = "*.{xlsx,xls}"
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?/+"
_BATCH_CELLS = 50_000
# Number formats that show dates and times.
_BUILT_IN_DATES = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_TEXT, _RUN, _ROW, _CELL, _DATA = (_MAIN + tag for tag in ("t", "r", "row", "c", "sheetData"))
_LETTERS = re.compile("[A-Z]+")
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def list_workbooks(spark: SparkSession, path: str, latest_only: bool = False) -> DataFrame:
    """``file, content`` of the spreadsheets in a folder, or of one file.

    Lock files, whose names start with ``~``, are left out.  A missing path is
    an error.  ``file`` is the name of the file; files that lie elsewhere than in
    the given folder have their own folder after it (see ``base_name``), so that
    equal names in two folders are two files.
    """
    return _listed(spark, path, latest_only).select("file", "content")


def _listed(spark: SparkSession, path: str, latest_only: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", _NAMES)
    files = _named(reader.load(path), path, "length")
    return latest_file(files) if latest_only else files


def _named(files: DataFrame, source: str, *others: str) -> DataFrame:
    place = F.regexp_replace("path", _AUTHORITY, "/")
    root = re.sub(_AUTHORITY, "/", source).rstrip("/")
    name = F.substring_index(place, "/", -1)
    folder = F.left(place, F.length(place) - F.length(name) - 1)
    file = F.when((folder == root) | (place == root), name).otherwise(F.concat_ws(FOLDER_MARK, name, folder))
    return files.select(file.alias("file"), *others, "content").filter(~F.col("file").startswith("~"))


def read_workbooks(spark: SparkSession, path: str, latest_only: bool = False) -> DataFrame:
    """The cells of the active sheet of every workbook, cached values only.

    A workbook that cannot be read gives one row with ``error`` set instead of
    failing the job; old binary ``.xls`` files are reported this way.
    """
    return decode(list_workbooks(spark, path, latest_only))


def read_rows(spark: SparkSession, path: str, latest_only: bool = False, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows of the same sheets, each with the texts of its cells from the first column on.

    Of a workbook of more than ``max_bytes`` only the length is read; it gives a row with ``error``.
    """
    files = _listed(spark, path, latest_only)
    large = files.filter(F.col("length") > max_bytes).select(
        "file", F.lit(None).cast("long").alias("row_idx"), F.lit(None).cast("array<string>").alias("values"),
        F.concat(F.lit("too large: "), F.col("length").cast("string"), F.lit(" bytes")).alias("error"),
    )
    return decode_rows(files.filter(F.col("length") <= max_bytes)).unionByName(large)


def stream_workbooks(spark: SparkSession, path: str, log: str, files_per_batch: int = 0) -> DataFrame:
    """S2 as a stream: ``file, version, content`` of workbooks as they arrive in a folder or are written anew.

    ``log`` is the folder in which the versions that were seen are kept.
    """
    spark.dataSource.register(FileVersions)
    files = (
        spark.readStream.format(FORMAT)
        .option("pattern", "*.xlsx,*.xls")
        .option("filesPerBatch", files_per_batch)
        .option("log", log)
        .load(path)
    )
    return _named(files, path, "version")


def decode(files: DataFrame) -> DataFrame:
    return files.select("file", "content").mapInArrow(_decode_batches, GRID_SCHEMA)


def decode_rows(files: DataFrame) -> DataFrame:
    """``file, content`` -> rows; a ``version`` of the file is kept beside them, so that the content is read once."""
    kept = ["version"] if "version" in files.columns else []
    return files.select("file", "content", *kept).mapInArrow(_decode_rows, ROW_SCHEMA + "".join(f", {c} long" for c in kept))


def _decode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = batch.schema.names[2:]
        for i, (name, content) in enumerate(zip(batch.column(0), batch.column(1))):
            for rows in _file_rows(name.as_py(), content):
                own = [pa.array([batch[c][i].as_py()] * rows.num_rows, pa.int64()) for c in kept]
                yield pa.RecordBatch.from_arrays([*rows.columns, *own], names=[*rows.schema.names, *kept])


def _file_rows(file: str, content: pa.Scalar) -> Iterator[pa.RecordBatch]:
    try:
        yield from _row_batches(file, content.as_buffer())
    except Exception as error:  # one bad file must not stop the others
        columns = [[file], [None], [None], [f"{type(error).__name__}: {error}"]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROW_ARROW)], schema=_ROW_ARROW)


def _row_batches(file: str, content) -> Iterator[pa.RecordBatch]:
    numbers, ends, values, cells = [], [0], [], 0

    def rows() -> pa.RecordBatch:
        ends.append(len(values))
        n = len(numbers)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.string()))
        columns = [pa.array([file] * n), pa.array(numbers, pa.int64()), lists, pa.nulls(n, pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema=_ROW_ARROW)

    for row, col, value in sheet_cells(pa.BufferReader(content)):
        if not numbers or row != numbers[-1]:
            if len(values) >= _BATCH_CELLS:
                yield rows()
                numbers, ends, values = [], [0], []
            elif numbers:
                ends.append(len(values))
            numbers.append(row)
        values.extend([None] * (ends[-1] + col + 1 - len(values)))
        values[ends[-1] + col] = value
        cells += 1
    if not cells:
        raise ValueError("the sheet has no cells")
    yield rows()


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column(0), batch.column(1)):
            file = name.as_py()
            try:
                yield from _cell_batches(file, content.as_buffer())
            except Exception as error:  # one bad file must not stop the others
                yield _batch([(file, None, None, None, f"{type(error).__name__}: {error}")])


def _cell_batches(file: str, content) -> Iterator[pa.RecordBatch]:
    rows, empty = [], True
    for row, col, value in sheet_cells(pa.BufferReader(content)):
        rows.append((file, row, col, value, None))
        empty = False
        if len(rows) >= _BATCH_CELLS:
            yield _batch(rows)
            rows = []
    if empty:
        raise ValueError("the sheet has no cells")
    yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_ARROW_SCHEMA)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _ARROW_SCHEMA)]
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW_SCHEMA)


def sheet_cells(source: io.IOBase) -> Iterator[tuple[int, int, str | None]]:
    """Zero-based row, column and text of each cell of the active sheet.

    The sheet is read as a stream; only the shared strings are held whole.
    """
    with zipfile.ZipFile(source) as book:
        strings, dates = _shared_strings(book), _date_formats(book)
        with book.open(_active_sheet(book)) as sheet:
            row_no, rows = -1, None
            for event, element in ElementTree.iterparse(sheet, events=("start", "end")):
                tag = element.tag
                if event == "start":
                    if tag == _ROW:
                        row_no = int(element.get("r", row_no + 2)) - 1
                        col_no = -1
                    elif tag == _DATA:
                        rows = element
                elif tag == _CELL:
                    col_no = _column_number(element.get("r"), col_no + 1)
                    yield row_no, col_no, _cell_text(element, strings, dates)
                elif tag == _ROW:
                    rows.clear()  # drop the finished row, also from its parent


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    part = "xl/sharedStrings.xml"
    if part not in book.namelist():
        return []
    strings = []
    with book.open(part) as xml:
        for _, element in ElementTree.iterparse(xml):
            if element.tag == _MAIN + "si":
                strings.append(_rich_text(element))
                element.clear()
    return strings


def _rich_text(element: ElementTree.Element) -> str:
    """Text of plain and formatted runs, without phonetic guides."""
    direct, runs = [], []
    for part in element:
        if part.tag == _TEXT:
            direct.append(part.text or "")
        elif part.tag == _RUN:
            runs += [t.text or "" for t in part.findall(_TEXT)]
    return "".join(direct + runs)


def _active_sheet(book: zipfile.ZipFile) -> str:
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    view = root.find(f"{_MAIN}bookViews/{_MAIN}workbookView")
    active = int(view.get("activeTab", 0)) if view is not None else 0
    sheets = root.findall(f"{_MAIN}sheets/{_MAIN}sheet")
    wanted = sheets[active if active < len(sheets) else 0].get(_REL + "id")
    for relation in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if relation.get("Id") == wanted:
            target = relation.get("Target")
            return target.lstrip("/") if target.startswith("/") else posixpath.normpath("xl/" + target)
    raise ValueError("the active sheet has no part")


def _column_number(reference: str | None, default: int) -> int:
    letters = _LETTERS.match(reference) if reference else None
    return _letters_number(letters.group()) if letters else default


@lru_cache(maxsize=1 << 14)
def _letters_number(letters: str) -> int:
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


@dataclass
class DateFormats:
    """Which cell styles show a date, and the day that number 0 stands for."""

    styles: frozenset[int]
    first_day: datetime


def _date_formats(book: zipfile.ZipFile) -> DateFormats:
    """Styles whose number format is one of the built-in date formats or names a part of a date."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    settings = root.find(f"{_MAIN}workbookPr")
    late = settings is not None and settings.get("date1904") in ("1", "true")
    first_day = datetime(1904, 1, 1) if late else datetime(1899, 12, 30)
    if "xl/styles.xml" not in book.namelist():
        return DateFormats(frozenset(), first_day)
    sheet = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in sheet.iterfind(f"{_MAIN}numFmts/{_MAIN}numFmt")}
    dated = {
        i for i, code in own.items() if re.search("[ymdhs]", re.sub(r'"[^"]*"|\\.|\[(?![hms]+\])[^\]]*\]', "", code.lower()))
    }
    formats = [int(x.get("numFmtId", 0)) for x in sheet.iterfind(f"{_MAIN}cellXfs/{_MAIN}xf")]
    styles = (i for i, f in enumerate(formats) if f in dated or f in _BUILT_IN_DATES and f not in own)
    return DateFormats(frozenset(styles), first_day)


def _date_text(text: str, first_day: datetime) -> str:
    """ISO text of a day number: date and time, or the time alone below the first day."""
    number = float(text)
    if not 0 <= number < 2_958_466:
        return _number_text(text)
    moment = first_day + timedelta(seconds=round(number * 86_400))
    return moment.isoformat(" ") if number >= 1 else moment.time().isoformat()


def _cell_text(cell: ElementTree.Element, strings: list[str], dates: DateFormats) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = cell.find(_MAIN + "is")
        return None if inline is None else _rich_text(inline)
    value = cell.find(_MAIN + "v")
    if value is None or value.text is None:
        return None
    if kind == "s":
        return strings[int(value.text)]
    if kind == "b":
        return "True" if value.text == "1" else "False"
    if kind == "n":
        if int(cell.get("s", 0)) in dates.styles:
            return _date_text(value.text, dates.first_day)
        return _number_text(value.text)
    if kind == "d":
        return value.text.replace("T", " ")
    return value.text


def _number_text(text: str) -> str:
    """Whole numbers without decimals, others in their shortest form.

    How a number is stored decides: digits stay digits, powers of ten stay such.
    """
    if re.fullmatch(r"-?[0-9]+", text):
        return str(int(text))
    number = float(text)
    return str(int(number)) if number.is_integer() and "e" not in text.lower() else repr(number)
