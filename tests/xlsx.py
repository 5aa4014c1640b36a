"""A minimal xlsx writer for fixtures: sheets as lists of rows."""

from __future__ import annotations

import datetime
import zipfile
from xml.sax.saxutils import escape

EPOCH = datetime.date(1899, 12, 30)


def _name(col: int) -> str:
    out = ""
    while col:
        col, rest = divmod(col - 1, 26)
        out = chr(65 + rest) + out
    return out


def _cell(ref: str, value, shared: list[str]) -> str:
    if value is None or value == "":
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, datetime.date):
        return f'<c r="{ref}" s="1"><v>{(value - EPOCH).days}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value}</v></c>'
    if value.startswith("inline:"):
        return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value[7:])}</t></is></c>'
    if value not in shared:
        shared.append(value)
    return f'<c r="{ref}" t="s"><v>{shared.index(value)}</v></c>'


def write_workbook(path: str, sheets: dict[str, list[list]]) -> str:
    shared: list[str] = []
    parts: dict[str, str] = {}
    for number, rows in enumerate(sheets.values(), 1):
        body = ""
        for r, row in enumerate(rows, 1):
            cells = "".join(_cell(f"{_name(c)}{r}", v, shared) for c, v in enumerate(row, 1))
            body += f'<row r="{r}">{cells}</row>'
        width = max((len(row) for row in rows), default=1)
        ref = f"A1:{_name(width)}{max(len(rows), 1)}"
        parts[f"xl/worksheets/sheet{number}.xml"] = (
            '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
            f'<dimension ref="{ref}"/><sheetData>{body}</sheetData></worksheet>'
        )
    listed = "".join(
        f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>'
        for i, name in enumerate(sheets, 1)
    )
    parts["xl/workbook.xml"] = (
        '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
        'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
        f"<sheets>{listed}</sheets></workbook>"
    )
    relations = "".join(
        f'<Relationship Id="rId{i}" Type="x" Target="worksheets/sheet{i}.xml"/>'
        for i in range(1, len(sheets) + 1)
    )
    parts["xl/_rels/workbook.xml.rels"] = (
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f"{relations}</Relationships>"
    )
    parts["xl/styles.xml"] = (
        '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
        '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'
    )
    strings = "".join(f"<si><t xml:space=\"preserve\">{escape(s)}</t></si>" for s in shared)
    parts["xl/sharedStrings.xml"] = (
        '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
        f"{strings}</sst>"
    )
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return path
