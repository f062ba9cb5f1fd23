"""Workbooks made from cells."""

import pyarrow as pa

from sheetloom.plans.inputs import _book
from sheetloom.sources.workbook import sheet_cells


def test_a_book_holds_its_cells_in_order_and_no_nulls():
    rows = [(2, 1, "b & <c>"), (0, 0, "12"), (2, 0, "\uad6d\uac00"), (1, 0, None), (None, 3, "lost"), (2, 1, "b & <c>")]
    columns = zip(*rows)
    types = {"row_idx": pa.int64(), "col_idx": pa.int32(), "value": pa.string()}
    cells = pa.table({"file": ["f.xlsx"] * len(rows)} | {n: pa.array(c, t) for (n, t), c in zip(types.items(), columns)})
    book = _book(cells)
    assert book["file"].to_pylist() == ["f.xlsx"]
    found = list(sheet_cells(pa.BufferReader(book["content"][0].as_buffer())))
    assert found == [(0, 0, "12"), (2, 0, "\uad6d\uac00"), (2, 1, "b & <c>"), (2, 1, "b & <c>")]
