"""Workbook files to the long ``cells`` table.

Whole sheets or none. A workbook is read as three relations:

* sheet rows: the XML of each sheet, spread over the cluster and parsed there into numbered
  cells, followed by a *trailer*, one row per sheet with the number of its cells or the error
  that stopped it;
* the dictionary of shared strings, each written once per file whatever its number of sheets,
  followed by a trailer of its own;
* ``sheets``: the trailers of both put together, one row per sheet or broken file.

Cells refer to shared strings by number until they are joined with the dictionary. A sheet
whose trailer carries an error, or that refers to a string its file doesn't have, is left out
as a whole. Cells and their trailer are written by one task, so neither is there without the
other.
"""

from __future__ import annotations

import datetime
import io
import posixpath
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtide.functions.text import clean_text
from gridtide.operators.sheets import with_periods
from gridtide.operators.tables import cells_of_tables
from gridtide.schemas import CELLS
from gridtide.staging import stage

# Functions of this module travel to the executors whole: the package need not be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORKBOOK_NAME = r"(?i)\.xlsx?$"
ANY_WORKBOOK = "*.[xX][lL][sS]*"
SHEET_PARTS = (
    "source_file STRING, sheet_no INT, sheet STRING, xml BINARY, date_styles ARRAY<INT>, "
    "from_1904 BOOLEAN, error STRING"
)
# A cell, or (without row_no) the trailer of a sheet: cells, highest string number, error.
RAW_CELLS = (
    "source_file STRING, sheet_no INT, sheet STRING, row_no BIGINT, col_no INT, kind STRING, "
    "text STRING, num DOUBLE, date DATE, string_no BIGINT, n_cells BIGINT, max_string BIGINT, "
    "error STRING"
)
# A shared string, or (without string_no) the trailer of a dictionary: strings, error.
STRINGS = "source_file STRING, string_no BIGINT, text STRING, n_strings BIGINT, error STRING"
# Built-in number formats that show a date or time.
DATE_FORMATS = set(range(14, 23)) | set(range(27, 37)) | set(range(45, 48)) | set(range(50, 59))
BATCH = 50_000
_EPOCH = datetime.date(1899, 12, 30)
_DAYS_1904 = 1462


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _children(element, name: str) -> list:
    return [child for child in element if _tag(child) == name]


def _relation_id(element) -> str | None:
    return next((v for k, v in element.attrib.items() if k.endswith("}id")), None)


def _is_date_format(code: str) -> bool:
    bare = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", code.lower())
    return bool(re.search("[ymdhs]", bare)) and "general" not in bare


def _date_styles(archive: zipfile.ZipFile) -> list[int]:
    """Cell style indexes whose number format is a date."""
    if "xl/styles.xml" not in archive.namelist():
        return []
    root = ElementTree.fromstring(archive.read("xl/styles.xml"))
    custom = {
        int(fmt.get("numFmtId")): _is_date_format(fmt.get("formatCode", ""))
        for group in _children(root, "numFmts")
        for fmt in group
    }
    styles = [xf for group in _children(root, "cellXfs") for xf in group]
    formats = [int(xf.get("numFmtId", 0)) for xf in styles]
    return [i for i, f in enumerate(formats) if custom.get(f, f in DATE_FORMATS)]


def _sheet_parts(path: str, content: bytes) -> Iterator[tuple]:
    """One row per sheet: its XML and what is needed to read it, nothing parsed yet."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
        relations = ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target") for r in relations}
        names = set(archive.namelist())
        styles = _date_styles(archive)
        properties = [p for p in book if _tag(p) == "workbookPr"]
        from_1904 = any(p.get("date1904") in ("1", "true") for p in properties)
        sheets = [s for group in _children(book, "sheets") for s in group]
        for number, sheet in enumerate(sheets, 1):
            target = targets.get(_relation_id(sheet), "")
            part = target.lstrip("/") if target.startswith("/") else posixpath.join("xl", target)
            part = posixpath.normpath(part)
            if part not in names:
                continue
            xml = archive.read(part)
            yield path, number, sheet.get("name"), xml, styles, from_1904, None


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = _names(SHEET_PARTS)
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            try:
                for row in _sheet_parts(path, content):
                    yield pd.DataFrame([row], columns=columns)
            except Exception as error:  # a broken file is a row, not a lost job
                row = (path, None, None, None, None, None, f"{path}: {error}")
                yield pd.DataFrame([row], columns=columns)


def _column_number(reference: str) -> int:
    number = 0
    for char in reference:
        if not char.isalpha():
            break
        number = number * 26 + ord(char.upper()) - 64
    return number


def _row_number(reference: str) -> int:
    return int(reference.lstrip("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))


def _joined_text(element) -> str:
    return "".join(
        t.text or ""
        for part in element.iter()
        if _tag(part) == "t"
        for t in [part]
    )


def _strings_of(content: bytes) -> Iterator[str]:
    """Shared strings of a workbook in order."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        if "xl/sharedStrings.xml" not in archive.namelist():
            return
        with archive.open("xl/sharedStrings.xml") as part:
            for _, element in ElementTree.iterparse(part):
                if _tag(element) == "si":
                    yield _joined_text(element)
                    element.clear()


def _dictionary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = _names(STRINGS)
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows: list[tuple] = []
            number, problem = 0, None
            try:
                for text in _strings_of(content):
                    rows.append((path, number, text, None, None))
                    number += 1
                    if len(rows) == BATCH:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
            except Exception as error:
                problem = f"{path}: {error}"
            rows.append((path, None, None, None if problem else number, problem))
            yield pd.DataFrame(rows, columns=columns)


def _typed(cell, date_styles: set[int], from_1904: bool):
    """(kind, text, num, date, string number) of a cell element, or None when it is empty."""
    kind = cell.get("t", "n")
    value = next((child.text for child in cell if _tag(child) == "v"), None)
    if kind == "inlineStr":
        return "s", "".join(_joined_text(i) for i in _children(cell, "is")), None, None, None
    if value is None or kind == "e":
        return None
    if kind == "s":
        return "s", None, None, None, int(value)
    if kind == "str":
        return "s", value, None, None, None
    if kind == "b":
        return "b", "true" if value in ("1", "true") else "false", None, None, None
    if kind == "d":
        return "d", value[:10], None, datetime.date.fromisoformat(value[:10]), None
    number = float(value)
    if int(cell.get("s", 0)) in date_styles and 1 <= number < 2_958_466:
        days = int(number) + (_DAYS_1904 if from_1904 else 0)
        date = _EPOCH + datetime.timedelta(days=days)
        return "d", date.isoformat(), number, date, None
    return "n", value, number, None, None


def _sheet_cells(row) -> Iterator[tuple]:
    styles = set(row.date_styles if row.date_styles is not None else [])
    top, left, last_row = 1, 1, 0
    events = ElementTree.iterparse(io.BytesIO(row.xml), events=("start", "end"))
    last_col = 0
    for event, element in events:
        tag = _tag(element)
        if event == "start" and tag == "dimension":
            corner = element.get("ref", "A1").split(":")[0]
            top, left = _row_number(corner), _column_number(corner)
        elif event == "start" and tag == "row":
            last_row = int(element.get("r", last_row + 1))
            last_col = 0
        elif event == "end" and tag == "c":
            reference = element.get("r")
            last_col = _column_number(reference) if reference else last_col + 1
            typed = _typed(element, styles, bool(row.from_1904))
            if typed is not None and (typed[1] is None or typed[1].strip()):
                yield last_row - top + 1, last_col - left + 1, *typed
        elif event == "end" and tag == "row":
            element.clear()


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = _names(RAW_CELLS)

    def frame(row, cells):
        rows = [(row.source_file, row.sheet_no, row.sheet, *c, None, None, None) for c in cells]
        return pd.DataFrame(rows, columns=columns)

    def trailer(row, count, highest, error):
        values = (row.source_file, row.sheet_no, row.sheet, *(None,) * 7, count, highest, error)
        return pd.DataFrame([values], columns=columns)

    for batch in batches:
        for row in batch.itertuples():
            if row.error:
                yield trailer(row, None, None, row.error)
                continue
            pending: list[tuple] = []
            count, highest, problem = 0, None, None
            try:
                for cell in _sheet_cells(row):
                    pending.append(cell)
                    count += 1
                    if cell[-1] is not None:
                        highest = cell[-1] if highest is None else max(highest, cell[-1])
                    if len(pending) == BATCH:
                        yield frame(row, pending)
                        pending = []
            except Exception as error:
                problem = f"{row.source_file} [{row.sheet}]: {error}"
            if problem:
                yield trailer(row, None, None, problem)
                continue
            if pending:
                yield frame(row, pending)
            yield trailer(row, count, highest, None)


def _escaped(path: str) -> str:
    """A path whose name holds no pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _located(spark: SparkSession, paths: str | Sequence[str], recursive: bool) -> tuple[list[str], bool]:
    """What to load, each file once: files and, when ``recursive``, whole folders."""
    wanted = [paths] if isinstance(paths, str) else list(paths)
    if not wanted:
        raise ValueError("no workbook paths were supplied")
    if not all(isinstance(path, str) for path in wanted):
        raise ValueError("workbook paths must be strings")
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    files: set[str] = set()
    folders: set[str] = set()
    for path in wanted:
        target = hadoop.Path(path)
        fs = target.getFileSystem(conf)
        if not fs.exists(target):
            raise ValueError(f"path does not exist: {path}")
        root = fs.makeQualified(target).toString().rstrip("/")
        if fs.getFileStatus(target).isFile():
            if not re.search(WORKBOOK_NAME, path):
                raise ValueError(f"unsupported file {path}; expected .xls or .xlsx")
            files.add(root)
        elif recursive:
            folders.add(root)
        else:  # only these two folders are listed, whatever lies below
            for folder in (root, root + "/workbooks"):
                found = fs.globStatus(hadoop.Path(f"{_escaped(folder)}/{ANY_WORKBOOK}")) or []
                files.update(f.getPath().toString() for f in found if f.isFile())
    folders = {f for f in folders if not any(f.startswith(other + "/") for other in folders)}
    files = {f for f in files if re.search(WORKBOOK_NAME, f) and not any(f.startswith(d + "/") for d in folders)}
    return sorted(map(_escaped, files | folders)), bool(folders)


def open_workbooks(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """binaryFile rows of exactly the given files."""
    return spark.read.format("binaryFile").load([_escaped(path) for path in paths])


def workbook_files(
    spark: SparkSession, paths: str | Sequence[str], recursive: bool = False
) -> DataFrame:
    """Workbook files below the given files and directories (binaryFile rows), each once.

    A directory also contributes its ``workbooks`` folder; other subfolders only when
    ``recursive``. Raises when a path does not exist or nothing is found. Contents are read
    only where ``content`` is used.
    """
    located, recursive_found = _located(spark, paths, recursive)
    found = None
    if located:
        # Spark lists folders itself, in parallel where they are many; the name pattern prunes
        # that listing, so files other than workbooks are never opened.
        reader = spark.read.format("binaryFile")
        if recursive_found:
            reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", ANY_WORKBOOK)
        found = reader.load(located).where(F.col("path").rlike(WORKBOOK_NAME))
    if found is None or found.select("path").isEmpty():
        hint = "" if recursive else "; use recursive=True to search subfolders"
        raise ValueError(f"no .xls or .xlsx workbooks found{hint}")
    return found


def sheet_rows(
    files: DataFrame, tables: str | int | Sequence[str | int] | None = None
) -> DataFrame:
    """One row per sheet of (path, content) rows, not parsed yet; broken files give their error."""
    parts = files.select("path", "content").mapInPandas(_unzip, SHEET_PARTS)
    if tables is None:
        return parts
    broken = parts.where(F.col("error").isNotNull())
    return cells_of_tables(parts.where(F.col("error").isNull()), tables).unionByName(broken)


def raw_cells(
    files: DataFrame, tables: str | int | Sequence[str | int] | None = None
) -> DataFrame:
    """Numbered cells and trailers of (path, content) rows.

    Files are unzipped to one row per sheet first; sheets that were not asked for are
    dropped there, the rest is spread by sheet and parsed, so a workbook with many sheets
    is not one task and an unwanted sheet is never parsed.
    """
    spread = sheet_rows(files, tables).repartition("source_file", "sheet_no")
    return spread.mapInPandas(_parse, RAW_CELLS)


def shared_strings(files: DataFrame) -> DataFrame:
    """Dictionaries and their trailers of (path, content) rows."""
    return files.select("path", "content").mapInPandas(_dictionary, STRINGS)


def sheet_trailers(raw: DataFrame, strings: DataFrame) -> DataFrame:
    """One row per sheet or broken file: source_file, sheet_no, sheet, n_cells, error."""
    own = raw.where(F.col("row_no").isNull())
    books = strings.where(F.col("string_no").isNull()).select(
        "source_file", "n_strings", F.col("error").alias("strings_error")
    )
    highest = F.col("max_string")
    missing = F.concat_ws(
        "", "source_file", F.lit(" ["), "sheet", F.lit("]: no shared string "), highest.cast("string")
    )
    error = F.coalesce(
        "error",
        F.when(highest.isNotNull(), F.col("strings_error")),
        F.when(highest >= F.coalesce("n_strings", F.lit(0)), missing),
    )
    return own.join(books, "source_file", "left").select(
        "source_file", "sheet_no", "sheet",
        F.when(error.isNull(), F.col("n_cells")).alias("n_cells"), error.alias("error"),
    )


def whole_sheets(raw: DataFrame, strings: DataFrame, sheets: DataFrame) -> DataFrame:
    """The cells of all sheets without an error, shared strings filled in.

    Sheets with an error are few, so an anti-join on them moves no cells; only cells that refer
    to a string are joined with the dictionary.
    """
    bad = sheets.where(F.col("error").isNotNull() & F.col("sheet_no").isNotNull())
    cells = raw.where(F.col("row_no").isNotNull()).join(
        bad.select("source_file", "sheet_no"), ["source_file", "sheet_no"], "left_anti"
    )
    texts = strings.where(F.col("string_no").isNotNull()).select(
        "source_file", "string_no", F.col("text").alias("shared")
    )
    plain = cells.where(F.col("string_no").isNull()).select(*CELLS.names)
    numbered = cells.where(F.col("string_no").isNotNull()).drop("text")
    referring = numbered.join(texts, ["source_file", "string_no"]).withColumnRenamed("shared", "text")
    found = plain.unionByName(referring.select(*CELLS.names))
    return found.where(clean_text(F.col("text")).isNotNull())


def parse_workbooks(
    files: DataFrame, tables: str | int | Sequence[str | int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Cells of whole sheets, and one row per sheet with the number of its cells or its error.

    Sheets and dictionaries are parsed once and written to the staging folder; a file without
    sheets has no row in either.
    """
    raw = stage(raw_cells(files, tables), "raw-cells")
    strings = stage(shared_strings(files), "shared-strings")
    sheets = sheet_trailers(raw, strings)
    return whole_sheets(raw, strings, sheets), sheets


def read_cells(
    spark: SparkSession,
    paths: str | Sequence[str],
    tables: str | int | Sequence[str | int] | None = None,
    recursive: bool = False,
    mode: str = "failfast",
) -> DataFrame:
    """The ``cells`` table of workbooks, with parsed periods; best written to Parquet.

    ``mode="permissive"`` leaves broken files and sheets out as a whole (see
    :func:`read_errors`); "failfast" raises with the path and the reason.
    """
    if mode not in ("failfast", "permissive"):
        raise ValueError(f"unknown mode {mode!r}; expected failfast or permissive")
    cells, sheets = parse_workbooks(workbook_files(spark, paths, recursive), tables)
    if mode == "failfast":
        broken = sheets.where(F.col("error").isNotNull()).select("error").first()
        if broken is not None:
            raise ValueError(f"failed to read workbook {broken['error']}")
    return with_periods(cells)


def read_errors(
    spark: SparkSession, paths: str | Sequence[str], recursive: bool = False
) -> DataFrame:
    """Files and sheets that cannot be read, with the reason."""
    _, sheets = parse_workbooks(workbook_files(spark, paths, recursive))
    return sheets.where(F.col("error").isNotNull()).select("source_file", "sheet", "error")


def sheets_of(files: DataFrame) -> DataFrame:
    """Sheets of (path, content) rows in order, without parsing them."""
    return sheet_rows(files).where(F.col("error").isNull()).select("source_file", "sheet_no", "sheet")


def sheet_names(
    spark: SparkSession, paths: str | Sequence[str], recursive: bool = False
) -> DataFrame:
    """Sheets of workbooks in order, without parsing them."""
    return sheets_of(workbook_files(spark, paths, recursive))
