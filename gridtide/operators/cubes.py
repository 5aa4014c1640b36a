"""Data cubes and raw sheets: header detection, footers, unpivot, long records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from gridtide.functions.numbers import cell_number
from gridtide.functions.text import clean_text, normalise_name
from gridtide.operators.sheets import (
    dense_grid, join_column_facts, join_row_facts, join_sheets, with_periods,
)
from gridtide.schemas import CUBE, SHEET
from gridtide.staging import stage

# How a footer row starts, the sentence it may contain, and the words
# that mark a sheet as notes.
FOOTER_STARTS = ["note", "source", "footnote", "comments", "©"]
FOOTER_SENTENCE = "cells in this table"
NOTES_NAMES = ["note", "contents", "cover"]
NOTES_STARTS = ["note", "explanatory"]
NOTES_ROWS = 3

PROVENANCE = ["source_file", "cat_no", "release_date", "cube", "cube_title", "sheet"]


def _starts(text: Column, words: list[str]) -> Column:
    return F.lower(text).rlike("^(" + "|".join(words) + ")")


# ---------------------------------------------------------------- footers and notes


def row_starts(cells: DataFrame) -> DataFrame:
    """First filled column of every row (a hash aggregate of ordinals only)."""
    return cells.groupBy(*SHEET, "row_no").agg(F.min("col_no").alias("col_no"))


def footer_rows(cells: DataFrame) -> DataFrame:
    """Rows that read as a note, source or copyright line.

    The start of a row's text is the start of its first filled cell; the sentence may run over
    several cells. One pass over the cells finds those that may begin or hold such a text, which
    are few; a second one reads the rows of the doubtful ones whole (at most the columns of a
    sheet).
    """
    row = [*SHEET, "row_no"]
    text = F.col("text")
    plain = cells.select(*row, "col_no", F.lower(clean_text(text)).alias("text"))
    words = FOOTER_SENTENCE.split()
    opens = F.lit(False)
    for n in range(1, len(words)):
        opens = opens | text.endswith(" ".join(words[:n]))
    starts, whole = _starts(text, FOOTER_STARTS), text.contains(FOOTER_SENTENCE)
    candidates = stage(
        plain.where(starts | whole | opens).select(
            *row, "col_no", (whole | (starts & (F.col("col_no") == 1))).alias("is_footer")
        ),
        "footer-candidates",
    )
    sure = candidates.where("is_footer").select(*row).distinct()
    doubtful = candidates.where("not is_footer").select(*row).distinct()
    rows = plain.where(text.isNotNull()).join(doubtful, row, "left_semi").groupBy(*row).agg(
        F.array_sort(F.collect_list(F.struct("col_no", "text"))).alias("cells")
    )
    joined = F.array_join(F.transform("cells", lambda c: c["text"]), " ")
    reads = _starts(F.col("cells")[0]["text"], FOOTER_STARTS) | joined.contains(FOOTER_SENTENCE)
    return sure.unionByName(rows.where(reads).select(*row)).distinct()


def with_footer(cells: DataFrame, header: DataFrame) -> DataFrame:
    """Add ``footer_row``, the first footer below the header (one past the end if none)."""
    found = first_footer(cells, header.select(*SHEET, "max_row", "header_row"))
    return header.join(found, SHEET, "left").withColumn(
        "footer_row", F.coalesce("footer_row", F.col("max_row") + 1)
    )


def first_footer(cells: DataFrame, header: DataFrame) -> DataFrame:
    """Row of the first footer below the header of each sheet that has one."""
    below = join_sheets(footer_rows(cells), header).where(
        F.col("row_no") > F.col("header_row")
    )
    return below.groupBy(*SHEET).agg(F.min("row_no").alias("footer_row"))


def notes_sheets(cells: DataFrame, extents: DataFrame | None = None) -> DataFrame:
    """Sheets that hold notes, contents or a cover rather than data: by name, or by the beginning
    of one of their first rows, counted from the first that holds anything."""
    extents = stage(_extents(cells), "extents") if extents is None else extents
    name = F.lower(F.col("sheet"))
    named = F.lit(False)
    for word in NOTES_NAMES:
        named = named | name.contains(word)
    filled = cells.where(clean_text(F.col("text")).isNotNull())
    starts = join_sheets(
        filled.where(_starts(clean_text(F.col("text")), NOTES_STARTS)).select(*SHEET, "row_no", "col_no"),
        extents.select(*SHEET, "max_row", "min_row"),
    ).where(F.col("row_no") < F.col("min_row") + NOTES_ROWS)
    rows = filled.join(starts.select(*SHEET, "row_no").distinct(), [*SHEET, "row_no"], "left_semi")
    first = starts.join(row_starts(rows), [*SHEET, "row_no", "col_no"], "left_semi")
    found = [extents.where(named), first]
    return reduce(DataFrame.unionByName, [df.select(*SHEET) for df in found]).distinct()


def _extents(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*SHEET, "sheet").agg(
        F.max("row_no").alias("max_row"),
        F.min(F.when(clean_text(F.col("text")).isNotNull(), F.col("row_no"))).alias("min_row"),
    )


def without_notes(cells: DataFrame) -> DataFrame:
    extents = stage(_extents(cells), "extents")
    notes = stage(extents.join(notes_sheets(cells, extents), SHEET, "left_semi"), "notes-sheets")
    if notes.isEmpty():
        return cells
    return join_sheets(cells, notes, "left_anti")


# ---------------------------------------------------------------- names


def unique_names(columns: DataFrame, base: Column) -> DataFrame:
    """Number repeated names ``name``, ``name_2``, ... from left to right per sheet.

    A numbered name that meets a name the sheet already uses is numbered once more, and
    as a last resort gets its column number, so the result has no duplicates.
    """

    def numbered(df: DataFrame, order: list) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*SHEET, "name").orderBy(*order))
        return df.withColumn("rank", rank).withColumns(
            {
                "made": F.col("made") | (F.col("rank") > 1),
                "name": F.when(F.col("rank") == 1, F.col("name")).otherwise(
                    F.concat_ws("_", "name", F.col("rank").cast("string"))
                ),
            }
        )

    out = columns.withColumns({"name": base, "made": F.lit(False)})
    out = numbered(out, ["col_no"])
    out = numbered(out, ["made", "col_no"])
    clash = F.row_number().over(W.partitionBy(*SHEET, "name").orderBy("made", "col_no")) > 1
    last = F.when(clash, F.concat_ws("_c", "name", F.col("col_no").cast("string")))
    return out.withColumn("name", F.coalesce(last, "name")).drop("rank", "made")


def header_rows(cells: DataFrame, skip_empty_rows: bool) -> DataFrame:
    """Header row per sheet: the first with more than one filled cell, else the first row."""
    filled = cells.groupBy(*SHEET, "sheet", "row_no").agg(
        F.count(F.lit(1)).alias("n"), F.max("col_no").alias("last_col")
    )
    first = F.min("row_no") if skip_empty_rows else F.lit(1)
    return filled.groupBy(*SHEET, "sheet").agg(
        F.coalesce(F.min(F.when(F.col("n") > 1, F.col("row_no"))), first).alias("header_row"),
        F.max("row_no").alias("max_row"),
        F.max("last_col").alias("max_col"),
    )


def column_names(cells: DataFrame, header: DataFrame) -> DataFrame:
    """Name of every column of a sheet, ``ColumnN`` where its header cell is blank."""
    titles = join_sheets(
        cells.select(*SHEET, "row_no", "col_no", "text"),
        header.select(*SHEET, "max_row", "header_row"),
    ).where(F.col("row_no") == F.col("header_row"))
    slots = header.select(
        *SHEET, "max_row", F.explode(F.sequence(F.lit(1), F.col("max_col"))).alias("col_no")
    )
    columns = slots.join(titles.select(*SHEET, "col_no", "text"), [*SHEET, "col_no"], "left")
    title = clean_text(F.col("text"))
    base = F.when(title.isNotNull(), normalise_name(title)).otherwise(
        F.concat(F.lit("Column"), F.col("col_no").cast("string"))
    )
    return unique_names(columns, base).select(*SHEET, "col_no", "max_row", "name")


def _records(cells: DataFrame, header: DataFrame) -> DataFrame:
    """Cells below the header and above ``footer_row``, each under its column's name."""
    names = stage(column_names(cells, header), "names")
    below = join_sheets(cells, header.select(*SHEET, "max_row", "header_row", "footer_row")).where(
        (F.col("row_no") > F.col("header_row")) & (F.col("row_no") < F.col("footer_row"))
    )
    return join_column_facts(below.drop("max_row"), names).select(
        *SHEET, "sheet", "row_no", "col_no", "name", "kind", "text", "num", "date"
    )


def raw_records(cells: DataFrame, header_row: int | None = None) -> DataFrame:
    """Sheets as they are: one record per filled cell below the header, named by it."""
    header = header_rows(cells, skip_empty_rows=False)
    if header_row is not None:
        header = header.withColumn("header_row", F.lit(header_row))
    header = header.withColumn("footer_row", F.col("max_row") + 1)
    return _records(cells, stage(header, "raw-header"))


def to_wide(records: DataFrame, names: list[str], value: str = "text") -> DataFrame:
    """Promote the given record names to columns, one row per sheet row.

    The caller names the columns, so no pass over the data has to find them.
    """
    keys = [*SHEET, "sheet", "row_no"]
    return records.groupBy(*keys).pivot("name", names).agg(F.first(value))


def dims_to_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Promote keys of a ``dims`` map to columns."""
    return df.select(
        *[c for c in df.columns if c != "dims"],
        *[F.try_element_at("dims", F.lit(name)).alias(name) for name in names],
    )


# ---------------------------------------------------------------- labelled matrix


def matrix_headers(cells: DataFrame) -> DataFrame:
    """Header of labelled-matrix sheets: first row with a period right of a filled cell."""
    rows = (
        with_periods(cells)
        .groupBy(*SHEET, "sheet", "row_no")
        .agg(
            F.min("col_no").alias("first_col"),
            F.max("col_no").alias("last_col"),
            F.min(F.when(F.col("period_date").isNotNull(), F.col("col_no"))).alias("period_col"),
        )
    )
    header = F.when(F.col("first_col") < F.col("period_col"), F.struct("row_no", "period_col"))
    return (
        rows.groupBy(*SHEET, "sheet")
        .agg(
            F.min(header).alias("header"),
            F.max("row_no").alias("max_row"),
            F.max("last_col").alias("max_col"),
        )
        .where(F.col("header").isNotNull())
        .select(
            *SHEET, "sheet", "max_row", "max_col",
            F.col("header.row_no").alias("header_row"),
            F.col("header.period_col").alias("first_period_col"),
        )
    )


def _matrix_cells(cells: DataFrame, header: DataFrame) -> DataFrame:
    facts = ["max_row", "max_col", "header_row", "first_period_col", "footer_row"]
    return join_sheets(cells, header.select(*SHEET, *facts)).where(
        (F.col("row_no") >= F.col("header_row")) & (F.col("row_no") < F.col("footer_row"))
    )


def _matrix_rows(cells: DataFrame, header: DataFrame) -> DataFrame:
    """Data rows with their dimensions: at least one of them is filled."""
    left = _matrix_cells(cells, header).where(F.col("col_no") < F.col("first_period_col"))
    titles = left.where(F.col("row_no") == F.col("header_row"))
    dim_cols = unique_names(
        titles.select(*SHEET, "col_no", "max_row", "text"), normalise_name(F.col("text"))
    ).select(*SHEET, "col_no", "max_row", "name")
    dim_cells = left.where(F.col("row_no") > F.col("header_row")).select(
        *SHEET, "sheet", "row_no", "col_no", "max_col", clean_text(F.col("text")).alias("text")
    )
    # As many entries per row as there are labelled columns before the first period.
    entries = F.array_sort(F.collect_list(F.struct("name", "text")))
    return (
        join_column_facts(dim_cells, dim_cols)
        .groupBy(*SHEET, "sheet", "row_no", "max_col")
        .agg(F.map_from_entries(entries).alias("dims"))
    )


def _matrix_observations(cells: DataFrame, header: DataFrame, rows: DataFrame) -> DataFrame:
    right = _matrix_cells(cells, header).where(F.col("col_no") >= F.col("first_period_col"))
    period_cols = right.where(
        (F.col("row_no") == F.col("header_row")) & F.col("period_date").isNotNull()
    ).select(*SHEET, "col_no", "max_row", "period_date", "period_frequency")
    number = cell_number(F.col("kind"), F.col("text"), F.col("num"))
    values = cells.select(*SHEET, "row_no", "col_no", number.alias("value"))
    grid = dense_grid(
        rows.select(*SHEET, "row_no", "max_col"),
        period_cols,
        values.where(F.col("value").isNotNull()),
    )
    return join_row_facts(grid, rows)


def _matrix(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observations of labelled-matrix sheets, and the staged rows they come from."""
    header = with_footer(cells, stage(matrix_headers(cells), "matrix-header"))
    header = stage(header, "matrix-extent")
    rows = stage(_matrix_rows(cells, header), "matrix-rows")
    out = _matrix_observations(cells, header, rows).withColumnsRenamed(
        {"period_date": "date", "period_frequency": "frequency"}
    )
    return out.select(
        *SHEET, "sheet", "row_no", "col_no", "date", "frequency", "value", "dims"
    ), rows


def matrix_cube(cells: DataFrame) -> DataFrame:
    """Observations of labelled-matrix sheets: date, frequency, value and a dims map.

    Every data row with at least one dimension gives one observation per period column,
    also where the cell is empty. Dates stay as the header gives them.
    """
    return _matrix(with_periods(cells))[0]


# ---------------------------------------------------------------- generic cubes


def generic_records(cells: DataFrame) -> DataFrame:
    """Sheet-shaped cubes in long form: one record per filled cell, footers cut."""
    header = stage(header_rows(cells, skip_empty_rows=True), "generic-header")
    return _records(cells, stage(with_footer(cells, header), "generic-extent"))


def generic_cube(cells: DataFrame) -> DataFrame:
    """Sheet-shaped cubes, one row per sheet row with its fields as a dims map."""
    entries = F.array_sort(F.collect_list(F.struct("name", "text")))
    rows = generic_records(cells).groupBy(*SHEET, "sheet", "row_no")
    return rows.agg(F.map_from_entries(entries).alias("dims"))


def read_cube(
    cells: DataFrame, family: str = "auto", metadata: dict[str, str | None] | None = None
) -> DataFrame:
    """Data cubes of all sheets: provenance, date, frequency, value and a dims map.

    ``family`` is "labelled_matrix", "generic", or "auto": matrix sheets first, the
    sheets that give nothing as generic ones. ``metadata`` may hold cat_no, release_date,
    cube and cube_title. Notes sheets are left out.
    """
    if family not in ("auto", "generic", "labelled_matrix"):
        raise ValueError(
            f"unsupported cube family {family!r}; expected auto, generic or labelled_matrix"
        )
    cells = without_notes(with_periods(cells))
    given = metadata or {}
    columns = {
        name: F.lit((given.get(name) or "").strip() or None).cast("string")
        for name in ("cat_no", "release_date", "cube", "cube_title")
    }
    parts = []
    if family != "generic":
        observations, rows = _matrix(cells)
        parts.append(observations)
    if family == "auto":
        extents = cells.groupBy(*SHEET).agg(F.max("row_no").alias("max_row"))
        done = extents.join(rows.select(*SHEET).distinct(), SHEET, "left_semi")
        cells = join_sheets(cells, stage(done, "matrix-sheets"), "left_anti")
    if family != "labelled_matrix":
        parts.append(generic_cube(cells))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    for name, kind in (("date", "date"), ("frequency", "string"), ("value", "double")):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(kind))
    return out.withColumns(columns).select(*CUBE, "dims")
