"""Workbook files rendered from the orders, for the queries over workbook sources.

A workbook holds ``BOOK`` order keys: a sheet per order status with a header and a row per order
(key, priority as a shared string, day, price). Some are damaged: every fifth one from the fifth
on has its second sheet cut off in the middle, every seventh from the third on names a string it
doesn't have, every eleventh from the sixth on is no workbook at all.
"""

from __future__ import annotations

import datetime
import io
import sys
import zipfile
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridtide.plans.inputs import table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BOOK = 500
STATUSES = ["F", "O", "P"]
HEADER = ["Order", "Priority", "Day", "Price"]
FIRST_DAY = datetime.date(1899, 12, 30)
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
FILES = "path STRING, length BIGINT, modificationTime TIMESTAMP, content BINARY"


def _sheet_xml(rows: list[list[tuple[str, object]]]) -> str:
    """Rows of (kind, value): n a number, d a day number, s the number of a shared string."""
    marks = {"n": "", "d": ' s="1"', "s": ' t="s"'}
    body = "".join(
        "<row>" + "".join(f"<c{marks[kind]}><v>{value!r}</v></c>" for kind, value in row) + "</row>"
        for row in rows
    )
    return f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>'


def workbook(sheets: dict[str, str], strings: list[str]) -> bytes:
    """A workbook file of sheets in XML and its shared strings; cell style 1 is a date."""
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    listed = "".join(
        f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="s{i}"/>' for i, name in enumerate(sheets, 1)
    )
    targets = "".join(
        f'<Relationship Id="s{i}" Target="worksheets/{i}.xml"/>' for i in range(1, len(sheets) + 1)
    )
    texts = "".join(f"<si><t>{escape(text)}</t></si>" for text in strings)
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f"<Relationships>{targets}</Relationships>",
        "xl/styles.xml": f'<styleSheet xmlns="{MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/sharedStrings.xml": f'<sst xmlns="{MAIN}">{texts}</sst>',
        **{f"xl/worksheets/{i}.xml": xml for i, xml in enumerate(sheets.values(), 1)},
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in parts.items():
            archive.writestr(zipfile.ZipInfo(name), text)
    return out.getvalue()


def _book(orders: pd.DataFrame) -> pd.DataFrame:
    number, version = int(orders["book"].iloc[0]), int(orders["version"].iloc[0])
    strings = HEADER + sorted(set(orders["o_orderpriority"]))
    place = {text: i for i, text in enumerate(strings)}
    sheets = {}
    for status in STATUSES:
        mine = orders[orders["o_orderstatus"] == status].sort_values("o_orderkey")
        rows = [[("s", place[name]) for name in HEADER]] if len(mine) else []
        for key, priority, day, price in zip(
            mine["o_orderkey"], mine["o_orderpriority"], mine["o_orderdate"], mine["o_totalprice"]
        ):
            rows.append([("n", int(key)), ("s", place[priority]), ("d", (day.date() - FIRST_DAY).days),
                         ("n", float(price) * version)])
        sheets[f"Status {status}"] = _sheet_xml(rows)
    if number % 5 == 4:
        cut = sheets["Status O"]
        sheets["Status O"] = cut[: 2 * len(cut) // 3]
    if number % 7 == 2:
        sheets["Status F"] = _sheet_xml([[("s", len(strings))]])
    content = workbook(sheets, strings) if number % 11 != 5 else b"no workbook"
    changed = pd.Timestamp("2024-01-01", tz="UTC") + pd.Timedelta(days=version, seconds=number)
    row = (f"/lake/orders-{number}.xlsx", len(content), changed, content)
    return pd.DataFrame([row], columns=["path", "length", "modificationTime", "content"])


def book_number(key: Column) -> Column:
    return F.floor(key / BOOK)


def order_books(spark: SparkSession, sf_dir: str, version: Column | None = None) -> DataFrame:
    """One row per workbook (path, length, modificationTime, content). ``version`` (of the
    column ``book``, 1 by default) multiplies prices and moves the time of change."""
    orders = table(spark, sf_dir, "orders").select(
        book_number(F.col("o_orderkey")).alias("book"), "o_orderkey", "o_orderstatus",
        "o_orderpriority", "o_orderdate", "o_totalprice",
    )
    numbered = orders.withColumn("version", F.lit(1) if version is None else version)
    return numbered.groupBy("book").applyInPandas(_book, FILES)
