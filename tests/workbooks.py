"""Hand-zipped workbooks for the tests."""

from __future__ import annotations

import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def _name(row: int, col: int) -> str:
    letters = ""
    col += 1
    while col:
        col, rest = divmod(col - 1, 26)
        letters = chr(65 + rest) + letters
    return f"{letters}{row + 1}"


def sheet_xml(rows: list[list], strings: list[str], merges: list[str]) -> str:
    out = []
    for r, row in enumerate(rows):
        cells = []
        for c, value in enumerate(row):
            ref = _name(r, c)
            if value is None:
                cells.append(f'<c r="{ref}" s="1"/>')
            elif isinstance(value, bool):
                cells.append(f'<c r="{ref}" t="b"><v>{int(value)}</v></c>')
            elif isinstance(value, (int, float)):
                cells.append(f'<c r="{ref}"><v>{value!r}</v></c>')
            elif value.startswith("inline:"):
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(value[7:])}</t></is></c>')
            elif value.startswith("formula:"):
                cells.append(f'<c r="{ref}" t="str"><f>A1</f><v>{escape(value[8:])}</v></c>')
            else:
                strings.append(value)
                cells.append(f'<c r="{ref}" t="s"><v>{len(strings) - 1}</v></c>')
        out.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
    merged = "".join(f'<mergeCell ref="{m}"/>' for m in merges)
    merged = f"<mergeCells>{merged}</mergeCells>" if merges else ""
    return f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(out)}</sheetData>{merged}</worksheet>'


def write_workbook(path: Path, *sheets: list[list], active: int = 0, merges: list[str] | None = None) -> Path:
    strings: list[str] = []
    parts = [sheet_xml(rows, strings, merges or []) for rows in sheets]
    entries = "".join(f'<sheet name="S{i}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i in range(len(parts)))
    links = "".join(f'<Relationship Id="rId{i + 1}" Type="t" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(parts)))
    half = lambda s: f"<r><t>{escape(s[:1])}</t></r><r><t>{escape(s[1:])}</t></r><rPh><t>x</t></rPh>"
    shared = "".join(
        f"<si>{half(s) if i % 2 else f'<t>{escape(s)}</t>'}</si>" for i, s in enumerate(strings)
    )
    with zipfile.ZipFile(path, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><bookViews><workbookView activeTab="{active}"/></bookViews>'
            f"<sheets>{entries}</sheets></workbook>",
        )
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}">{links}</Relationships>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{_MAIN}">{shared}</sst>')
        for i, part in enumerate(parts):
            book.writestr(f"xl/worksheets/sheet{i + 1}.xml", part)
    return path
