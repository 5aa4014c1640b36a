"""Sheets to tidy observations (one row per series and date) and to series metadata.

Both layouts work in two passes: *series facts* (identifier and attributes, one row per
series) are found first and staged, then the observations stream past them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.functions.numbers import cell_number, text_number
from gridtide.functions.periods import period_start, text_period
from gridtide.functions.text import (
    clean_text, looks_like_series_id, metadata_key, normalise_frequency,
)
from gridtide.operators.context import sheet_facts
from gridtide.operators.cubes import with_footer
from gridtide.operators.sheets import (
    best_date_row, dense_grid, first_by, infer_frequency, join_column_facts, join_row_facts,
    join_sheets, join_sheets_by_column, label_priority, label_role, with_periods,
)
from gridtide.schemas import ATTRIBUTES, LABELS, OBS, SERIES_META, SHEET
from gridtide.staging import stage

CONTEXT = ["sheet", "cat_no", "release_date", "table", "table_no", "table_title"]
SERIES = ["series_id", *ATTRIBUTES]


def _no_text() -> Column:
    return F.lit(None).cast("string")


def _column_name() -> Column:
    return F.concat(F.lit("Column "), F.col("col_no").cast("string"))


def _known_frequency() -> Column:
    named = normalise_frequency(F.col("frequency"))
    return F.when(named == "unknown", F.col("inferred")).otherwise(named)


def _values(cells: DataFrame) -> DataFrame:
    number = cell_number(F.col("kind"), F.col("text"), F.col("num"))
    return cells.select(*SHEET, "row_no", "col_no", number.alias("value")).where(
        F.col("value").isNotNull()
    )


# ---------------------------------------------------------------- time down


def _label_cells(cells: DataFrame, sheets: DataFrame) -> DataFrame:
    """Cells to the right of the label rows above the first date, with role and priority.

    When a label repeats in a sheet, its lowest row counts.
    """
    key = metadata_key(F.col("text"))
    first_col = cells.where(F.col("col_no") == 1).select(*SHEET, "row_no", key.alias("key"))
    above = F.col("row_no") < F.coalesce("first_date_row", F.col("max_row") + 1)
    label_rows = (
        join_sheets(
            first_col.where(label_role(F.col("key")).isNotNull()),
            sheets.select(*SHEET, "max_row", "max_col", "first_date_row"),
        )
        .where(above)
        .groupBy(*SHEET, "key")
        .agg(F.max("row_no").alias("row_no"), F.max("max_col").alias("max_col"))
        .select(
            *SHEET, "row_no", "max_col",
            label_role(F.col("key")).alias("role"),
            label_priority(F.col("key")).alias("priority"),
        )
    )
    body = cells.where(F.col("col_no") > 1).select(
        *SHEET, "row_no", "col_no", clean_text(F.col("text")).alias("label_text")
    )
    return join_row_facts(body, label_rows).where(F.col("label_text").isNotNull())


def _id_cells(cells: DataFrame, sheets: DataFrame) -> DataFrame:
    """Cells above the first date that look like a series identifier."""
    found = cells.where((F.col("col_no") > 1) & looks_like_series_id(F.col("text")))
    facts = sheets.select(*SHEET, "max_row", "first_date_row")
    above = F.col("row_no") < F.coalesce("first_date_row", F.col("max_row") + 1)
    return join_sheets(found, facts).where(above).select(
        *SHEET, "col_no",
        F.lit("found_id").alias("role"),
        F.col("row_no").alias("priority"),
        clean_text(F.col("text")).alias("label_text"),
    )


def down_series(
    cells: DataFrame, sheets: DataFrame, metadata: bool = True, label_only: bool = False
) -> DataFrame:
    """One row per series column of sheets with dates down column 1.

    ``label_only`` reads sheets by their label rows alone: they need a series-identifier
    row, and only columns with a proper identifier count.
    """
    if label_only:
        sheets = sheets.withColumn("first_date_row", F.lit(None).cast("bigint"))
    else:
        sheets = sheets.where(F.col("first_date_row").isNotNull() & (F.col("max_col") > 1))
    labels = _label_cells(cells, sheets)
    if not metadata:
        labels = labels.where(F.col("role") == "series_id")
    header = labels.select(*SHEET, "col_no", "role", "priority", "label_text").unionByName(
        _id_cells(cells, sheets)
    )
    columns = (
        cells.where(F.col("col_no") > 1)
        .select(*SHEET, "col_no")
        .distinct()
        .select(
            "*", _no_text().alias("role"), F.lit(None).cast("bigint").alias("priority"),
            _no_text().alias("label_text"),
        )
    )
    by_column = (
        columns.unionByName(header)
        .groupBy(*SHEET, "col_no")
        .agg(
            *[
                first_by(F.col("role") == role, "priority", "label_text").alias(role)
                for role in [*LABELS, "found_id"]
            ]
        )
    )
    if label_only:
        key = metadata_key(F.col("text"))
        labelled = cells.where((F.col("col_no") == 1) & (label_role(key) == "series_id"))
        by_column = by_column.withColumn(
            "series_id", F.coalesce("series_id", "found_id")
        ).where(looks_like_series_id(F.col("series_id")))
        sheets = sheets.join(labelled.select(*SHEET).distinct(), SHEET, "left_semi")
    facts = sheets.select(*SHEET, *CONTEXT, "max_row", "max_col", "inferred")
    frequency = normalise_frequency(F.col("frequency")) if label_only else _known_frequency()
    return join_sheets_by_column(by_column, facts).withColumns(
        {
            "series_id": F.coalesce("series_id", "found_id", _column_name()),
            "series": F.coalesce("series", _column_name()),
            "frequency": frequency,
        }
    ).select(*SHEET, "col_no", "max_row", *CONTEXT, *SERIES)


def _down_observations(cells: DataFrame, sheets: DataFrame, series: DataFrame) -> DataFrame:
    date_rows = join_sheets(
        cells.where((F.col("col_no") == 1) & F.col("period_date").isNotNull()).select(
            *SHEET, "row_no", "period_date"
        ),
        sheets.where(F.col("max_col") > 1).select(*SHEET, "max_row", "max_col"),
    ).drop("max_row")
    grid = dense_grid(
        date_rows,
        series.select(*SHEET, "col_no", "max_row"),
        _values(cells.where(F.col("col_no") > 1)),
    )
    return join_column_facts(grid, series)


# ---------------------------------------------------------------- time across


def across_header(cells: DataFrame, sheets: DataFrame) -> DataFrame:
    """Sheet facts plus the header row (the one with most periods) and its frequency."""
    rows = best_date_row(cells).withColumnRenamed("row_no", "header_row")
    headed = sheets.drop("inferred", "first_date_row").join(rows, SHEET)
    dates = cells.where(F.col("period_date").isNotNull())
    in_header = join_sheets(dates, headed.select(*SHEET, "max_row", "header_row")).where(
        F.col("row_no") == F.col("header_row")
    )
    return headed.join(infer_frequency(in_header, SHEET), SHEET)


def _from_header(cells: DataFrame, header: DataFrame) -> DataFrame:
    return join_sheets(cells, header.select(*SHEET, "max_row", "max_col", "header_row"))


def _below_header(cells: DataFrame, header: DataFrame, cut_footers: bool) -> DataFrame:
    below = F.col("row_no") > F.col("header_row")
    if not cut_footers:
        return _from_header(cells, header).where(below)
    facts = header.select(*SHEET, "max_row", "max_col", "header_row")
    cut = stage(with_footer(cells, facts), "across-footers")
    return join_sheets(cells, cut).where(below & (F.col("row_no") < F.col("footer_row")))


def across_series(
    cells: DataFrame, header: DataFrame, metadata: bool = True, cut_footers: bool = False
) -> DataFrame:
    """One row per series row below the header of sheets with dates across."""
    below = _below_header(cells, header, cut_footers).withColumn(
        "text", clean_text(F.col("text"))
    )
    is_id = looks_like_series_id(F.col("text"))
    number = text_number(F.col("text"))
    plain = ~is_id & text_period("text")["date"].isNull() & number.isNull()
    found = below.select(
        *SHEET, "row_no", "col_no", "text",
        F.when(is_id, "found_id").when(plain, "plain_text").alias("role"),
    )
    if metadata:
        role = label_role(metadata_key(F.col("text")))
        role_cols = (
            _from_header(cells, header)
            .where((F.col("row_no") == F.col("header_row")) & role.isNotNull())
            .select(*SHEET, "col_no", "max_row", role.alias("role"))
        )
        labelled = join_column_facts(below.select(*SHEET, "row_no", "col_no", "text"), role_cols)
        found = found.unionByName(labelled)
    by_row = found.groupBy(*SHEET, "row_no").agg(
        first_by(F.col("col_no") == 1, "col_no", "text").alias("first_text"),
        *[
            first_by(F.col("role") == role, "col_no", "text").alias(role)
            for role in ["found_id", "plain_text", *ATTRIBUTES]
        ],
    )
    named = by_row.withColumn("series_id", F.coalesce("found_id", "first_text")).where(
        F.col("series_id").isNotNull()
    )
    facts = header.select(*SHEET, *CONTEXT, "max_row", "max_col", "inferred")
    name = F.coalesce("series", "plain_text", "first_text") if metadata else F.col("first_text")
    return join_sheets(named, facts).withColumns(
        # A row without any name keeps an empty one.
        {"series": F.coalesce(name, F.lit("")), "frequency": _known_frequency()}
    ).select(*SHEET, "row_no", "max_col", *CONTEXT, *SERIES)


def _across_observations(cells: DataFrame, header: DataFrame, series: DataFrame) -> DataFrame:
    date_cols = _from_header(cells.where(F.col("period_date").isNotNull()), header).where(
        F.col("row_no") == F.col("header_row")
    ).select(*SHEET, "col_no", "max_row", "period_date")
    grid = dense_grid(series.select(*SHEET, "row_no", "max_col"), date_cols, _values(cells))
    return join_row_facts(grid, series)


# ---------------------------------------------------------------- public operators


def _time_down_sheets(sheets: DataFrame) -> DataFrame:
    return sheets.where(F.col("first_date_row").isNotNull() & (F.col("max_col") > 1))


def _other_sheets(sheets: DataFrame) -> DataFrame:
    return sheets.where(F.col("first_date_row").isNull() | (F.col("max_col") == 1))


def tidy(
    cells: DataFrame,
    metadata: bool = True,
    cat_no: str | None = None,
    release_date: str | None = None,
    layout: str = "auto",
    cut_footers: bool = False,
    ordinals: bool = False,
) -> DataFrame:
    """Observations of all sheets in ``cells``: the 17 fixed columns plus ``source_file``.

    ``layout`` is "auto" (dates down column 1, else dates across a header row), "down"
    or "across". ``metadata=False`` leaves the attribute columns null and infers the
    frequency from the dates. ``cut_footers`` ends a time-across sheet at its first
    note or source line. ``ordinals=True`` keeps ``col_no`` and ``row_no``, the order
    in which the sheet lists the observations.
    """
    if layout not in ("auto", "down", "across"):
        raise ValueError(f"unknown layout {layout!r}; expected auto, down or across")
    cells = with_periods(cells)
    sheets = stage(sheet_facts(cells, cat_no, release_date), "sheets")
    keep = ["source_file", *OBS] + (["col_no", "row_no"] if ordinals else [])
    date = period_start(F.col("period_date"), F.col("frequency"))
    parts = []
    if layout in ("auto", "down"):
        down = _time_down_sheets(sheets)
        series = stage(down_series(cells, down, metadata), "series")
        parts.append(_down_observations(cells, down, series))
    if layout in ("auto", "across"):
        rest = sheets if layout == "across" else _other_sheets(sheets)
        header = stage(across_header(cells, rest), "header")
        series = stage(across_series(cells, header, metadata, cut_footers), "series")
        parts.append(_across_observations(cells, header, series))
    return reduce(
        DataFrame.unionByName, [part.withColumn("date", date).select(*keep) for part in parts]
    )


def label_only_metadata(cells: DataFrame, sheets: DataFrame | None = None) -> DataFrame:
    """Series of sheets that only hold label rows; columns need a series identifier."""
    cells = with_periods(cells)
    sheets = sheets if sheets is not None else stage(sheet_facts(cells), "sheets")
    return _metadata_columns(down_series(cells, sheets, label_only=True))


def _metadata_columns(series: DataFrame) -> DataFrame:
    named = series.withColumn("source_workbook", F.col("source_file"))
    return named.select("source_file", *SERIES_META).distinct()


def series_metadata(
    cells: DataFrame, cat_no: str | None = None, release_date: str | None = None
) -> DataFrame:
    """One row per series with the attributes its sheet gives it, no observations.

    Sheets without dates in column 1 are read by their labels first; the others, and
    those where that finds nothing, by the layouts of :func:`tidy`. Only series facts
    are computed, never the observation grid.
    """
    cells = with_periods(cells)
    sheets = stage(sheet_facts(cells, cat_no, release_date), "sheets")
    undated = F.col("first_date_row").isNull()
    by_label = stage(label_only_metadata(cells, sheets), "label-series")
    first = by_label.join(sheets.where(undated).select(*SHEET), SHEET, "left_semi")
    done = first.select(*SHEET).distinct()
    down = _metadata_columns(down_series(cells, _time_down_sheets(sheets)))
    rest = _other_sheets(sheets).join(done, SHEET, "left_anti")
    across = stage(
        _metadata_columns(across_series(cells, stage(across_header(cells, rest), "header"))),
        "across-series",
    )
    # Dated sheets that gave no series fall back to their labels.
    left_over = _other_sheets(sheets).where(~undated).join(across, SHEET, "left_anti")
    last = by_label.join(left_over.select(*SHEET), SHEET, "left_semi")
    out = reduce(DataFrame.unionByName, [first, down, across, last])
    return out.select("source_file", *SERIES_META).distinct()


def join_metadata(observations: DataFrame, metadata: DataFrame) -> DataFrame:
    """Attach series metadata to observations by catalogue, sheet and series."""
    keys = ["cat_no", "sheet", "series_id"]
    new = [name for name in metadata.columns if name not in observations.columns or name in keys]
    return observations.join(metadata.select(*new), keys, "left")
