"""Per-sheet facts: extent, catalogue number, release, table title, frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.functions.releases import release_text
from gridtide.functions.text import clean_text, metadata_key, table_no
from gridtide.operators.sheets import (
    first_by, infer_frequency, join_sheets, label_role, with_periods,
)
from gridtide.schemas import CATALOGUE_KEYS, RELEASE_KEYS, SHEET
from gridtide.staging import stage

# The head of a sheet has at least so many rows, whatever its dates.
HEAD_ROWS = 30
# What a title, a catalogue number and a release read like.
TABLE_START = r"(?i)^tables?\s*[0-9]+[a-z]?\b"
TABLE_INSIDE = r"(?i)\btable\s*[0-9]+[a-z]?\b"
NUMBER = r"\b[0-9]{4}(?:\.[0-9]+)*\b"
CATALOGUE_TEXT = r"(?i)catalogue\s*(?:number|no\.?)?\s*:?\s*([0-9]{4}(?:\.[0-9]+)*)"
RELEASE_TEXT = r"(?i)release(?:d| date)?\s*:?\s*(.+)$"


def looks_like_table_title(text: Column) -> Column:
    """A cell that reads like ``Table 3. ...`` and is not a label."""
    inside = text.rlike(TABLE_INSIDE) & (F.length(text) > 12)
    is_label = label_role(metadata_key(text)).isNotNull()
    return ~is_label & (text.rlike(TABLE_START) | inside)


def table_title_score(text: Column) -> Column:
    start_bonus = F.when(text.rlike(TABLE_START), 1000).otherwise(0)
    return F.least(F.length(text), F.lit(300)) + start_bonus


def sheet_extent(cells: DataFrame) -> DataFrame:
    """One row per sheet: last row and column, first row dated in column 1."""
    dated = (F.col("col_no") == 1) & F.col("period_date").isNotNull()
    return (
        with_periods(cells)
        .groupBy(*SHEET, "sheet")
        .agg(
            F.max("row_no").alias("max_row"),
            F.max("col_no").alias("max_col"),
            F.min(F.when(dated, F.col("row_no"))).alias("first_date_row"),
        )
    )


def head_facts(cells: DataFrame, extents: DataFrame) -> DataFrame:
    """Catalogue number, release text and title in the head of each sheet: what is said first.

    The head is what lies above the first date of column 1, the whole sheet if there is none, and
    ``HEAD_ROWS`` rows at least. Nothing is numbered or windowed: labels, texts that say a number or
    a release, and titles are few and picked by filters; ordered minima of their rows choose.
    """
    text = F.col("text")
    plain = cells.select(*SHEET, "row_no", "col_no", clean_text(text).alias("text"))
    row = [*SHEET, "row_no"]
    label = metadata_key(text)
    labels = plain.where((F.col("col_no") == 1) & label.isin(CATALOGUE_KEYS + RELEASE_KEYS)).select(
        *row, label.alias("row_key")
    )
    number = F.regexp_extract(text, NUMBER, 0)
    beside = plain.where((F.col("col_no") > 1) & text.isNotNull()).join(labels.select(*row), row)
    right = beside.groupBy(*row).agg(
        first_by(number != "", "col_no", number).alias("right_number"),
        first_by(text.isNotNull(), "col_no", text).alias("right_text"),
    )
    free_number = F.regexp_extract(text, CATALOGUE_TEXT, 1)
    free_release = F.regexp_extract(text, RELEASE_TEXT, 1)
    lower = F.lower(text)
    saying = plain.where(lower.contains("catalogue") | lower.contains("release"))
    free = saying.groupBy(*row).agg(
        first_by(free_number != "", "col_no", free_number).alias("free_number"),
        first_by(free_release != "", "col_no", free_release).alias("free_release"),
    )
    rows = labels.join(right, row, "left").join(free, row, "full")
    row_key = F.coalesce("row_key", F.lit(""))
    labelled = F.when(row_key.isin(CATALOGUE_KEYS), F.col("right_number"))
    # A release label row gives its first text to the right or nothing at all.
    release = F.when(row_key.isin(RELEASE_KEYS), F.col("right_text")).otherwise(F.col("free_release"))
    said = rows.select(
        *row, F.coalesce(labelled, "free_number").alias("cat_no"), release.alias("release")
    ).groupBy(*SHEET).agg(
        F.min(F.when(F.col("cat_no").isNotNull(), F.struct("row_no", "cat_no"))).alias("cat"),
        F.min(F.when(F.col("release").isNotNull(), F.struct("row_no", "release"))).alias("rel"),
    )
    titles = plain.where(lower.contains("table") & looks_like_table_title(text))
    above = F.col("first_date_row").isNull() | (F.col("row_no") < F.col("first_date_row"))
    titled = join_sheets(titles, extents.select(*SHEET, "max_row", "first_date_row")).where(above)
    best = titled.groupBy(*SHEET).agg(
        first_by(
            text.isNotNull(), (F.col("row_no") > HEAD_ROWS), -table_title_score(text), "row_no", "col_no", text
        ).alias("title")
    )

    def in_head(name: str, value: str) -> Column:
        row_no = F.col(f"{name}.row_no")
        early = (row_no <= HEAD_ROWS) | F.col("first_date_row").isNull() | (row_no < F.col("first_date_row"))
        return F.when(early, F.col(f"{name}.{value}"))

    return (
        extents.select(*SHEET, "first_date_row")
        .join(said, SHEET, "left").join(best, SHEET, "left")
        .select(
            *SHEET, in_head("cat", "cat_no").alias("found_cat_no"),
            in_head("rel", "release").alias("found_release"), "title",
        )
    )


def sheet_facts(
    cells: DataFrame, cat_no: str | None = None, release_date: str | None = None
) -> DataFrame:
    """One row per sheet: extent, context columns and the frequency of column 1.

    Explicit ``cat_no`` and ``release_date`` win over what the sheet says.
    """
    cells = with_periods(cells)
    column_dates = cells.where((F.col("col_no") == 1) & F.col("period_date").isNotNull())
    extents = stage(sheet_extent(cells), "extents")
    joined = (
        extents
        .join(head_facts(cells, extents), SHEET, "left")
        .join(infer_frequency(column_dates, SHEET), SHEET, "left")
    )
    title = F.coalesce("title", "sheet")
    return joined.select(
        *SHEET, "sheet", "max_row", "max_col", "first_date_row", "inferred",
        _explicit(cat_no, F.col("found_cat_no")).alias("cat_no"),
        _explicit(release_date, release_text(F.col("found_release"))).alias("release_date"),
        F.col("sheet").alias("table"),
        F.coalesce(table_no(title), table_no(F.col("sheet"))).alias("table_no"),
        title.alias("table_title"),
    )


def sheet_context(
    cells: DataFrame, cat_no: str | None = None, release_date: str | None = None
) -> DataFrame:
    """Context columns of every sheet."""
    return sheet_facts(cells, cat_no, release_date).select(
        *SHEET, "sheet", "cat_no", "release_date", "table", "table_no", "table_title"
    )


def _explicit(given: str | None, inferred: Column) -> Column:
    given = (given or "").strip()
    return F.lit(given) if given else inferred
