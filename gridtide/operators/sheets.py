"""Sheet-level building blocks shared by all layout operators.

Nothing here (or above it) collects a sheet: a single sheet may hold a large share
of all cells. Per-sheet facts are aggregates with map-side combine, and a join
between cells and per-sheet facts is keyed by *tile*, a block of rows or columns,
so that one huge sheet spreads over many tasks. An ordinary sheet is one tile and
pays nothing for it. Blocks are dealt over a fixed number of tiles, so facts are
repeated that often at most, however far down the rows of a sheet lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from gridtide.functions.periods import cell_period, month_index
from gridtide.schemas import LABELS, SHEET

# A block is 2**14 rows by 2**10 columns.
ROW_BITS, COL_BITS = 14, 10
TILES = 16


def block(ordinal: Column, bits: int) -> Column:
    return F.shiftright(ordinal - 1, bits).cast("bigint")


def blocks(last: Column, bits: int) -> Column:
    """One row per block up to the last row or column."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), block(last, bits)))


def tile(ordinal: Column, bits: int) -> Column:
    """Tile of a row or column in joins with facts; -1 of one above or left of the first."""
    at = block(ordinal, bits)
    return F.when(at < 0, F.lit(-1).cast("bigint")).otherwise(at % TILES)


def tiled(facts: DataFrame, name: str, last: str, bits: int) -> DataFrame:
    """Facts once for each tile up to the row or column ``last``, numbered in ``name``.

    A join with a small table, not an explode, which Spark would take for no more rows than
    before it: what is small enough to broadcast is to be seen from its size.
    """
    numbers = facts.sparkSession.range(-1, TILES).withColumnRenamed("id", name)
    at, number = block(F.col(last), bits), F.col(name)
    inside = ((number >= 0) & (number <= at)) | ((number < 0) & (at < 0))
    return facts.join(F.broadcast(numbers), inside)


def with_periods(cells: DataFrame) -> DataFrame:
    """Cells plus ``period_date`` and ``period_frequency``; parsed once, best stored so."""
    if "period_date" in cells.columns:
        return cells
    return cells.withColumn("_period", cell_period()).select(
        *cells.columns,
        F.col("_period.date").alias("period_date"),
        F.col("_period.frequency").alias("period_frequency"),
    )


def join_sheets(df: DataFrame, sheets: DataFrame, how: str = "inner") -> DataFrame:
    """Join rows that have ``row_no`` with per-sheet facts, spread over row blocks.

    ``sheets`` must carry ``max_row``.
    """
    left = df.withColumn("row_block", tile(F.col("row_no"), ROW_BITS))
    right = tiled(sheets, "row_block", "max_row", ROW_BITS)
    if how in ("left_anti", "left_semi"):
        right = right.select(*SHEET, "row_block")
    return left.join(right, [*SHEET, "row_block"], how).drop("row_block")


def join_sheets_by_column(df: DataFrame, sheets: DataFrame) -> DataFrame:
    """As :func:`join_sheets` for rows that have ``col_no`` only."""
    left = df.withColumn("col_block", tile(F.col("col_no"), COL_BITS))
    right = tiled(sheets, "col_block", "max_col", COL_BITS)
    return left.join(right, [*SHEET, "col_block"]).drop("col_block")


def dense_grid(rows: DataFrame, cols: DataFrame, values: DataFrame) -> DataFrame:
    """Every row x column of a sheet with the value of its cell, null where there is none.

    The grid *is* the result (missing observations stay as null rows), so it is built by
    an equi-join on the tile: each task sees at most one tile, whatever the sheet size.
    ``rows`` needs ``row_no`` and ``max_col``, ``cols`` needs ``col_no`` and ``max_row``.
    """
    left = (
        rows.withColumn("row_block", block(F.col("row_no"), ROW_BITS))
        .withColumn("col_block", blocks(F.col("max_col"), COL_BITS))
        .drop("max_col")
    )
    right = (
        cols.withColumn("col_block", block(F.col("col_no"), COL_BITS))
        .withColumn("row_block", blocks(F.col("max_row"), ROW_BITS))
        .drop("max_row")
    )
    tile = [*SHEET, "row_block", "col_block"]
    grid = left.join(right, tile).drop("row_block", "col_block")
    return grid.join(values, [*SHEET, "row_no", "col_no"], "left")


def join_column_facts(df: DataFrame, cols: DataFrame) -> DataFrame:
    """Attach per-column facts to cells; a long column is split by row block."""
    left = df.withColumn("row_block", tile(F.col("row_no"), ROW_BITS))
    right = tiled(cols, "row_block", "max_row", ROW_BITS).drop("max_row")
    return left.join(right, [*SHEET, "col_no", "row_block"]).drop("row_block")


def join_row_facts(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Attach per-row facts to cells; a wide row is split by column block."""
    left = df.withColumn("col_block", tile(F.col("col_no"), COL_BITS))
    right = tiled(rows, "col_block", "max_col", COL_BITS).drop("max_col")
    return left.join(right, [*SHEET, "row_no", "col_block"]).drop("col_block")


def first_by(condition: Column, *order_and_value: str | Column) -> Column:
    """Value of the least (order..., value) struct among the rows that meet a condition."""
    *order, value = [F.col(x) if isinstance(x, str) else x for x in order_and_value]
    names = [column.alias(f"k{i}") for i, column in enumerate(order)]
    return F.min(F.when(condition, F.struct(*names, value.alias("value"))))["value"]


def _label_lookup(key: Column, rank: bool) -> Column:
    entries = [
        f"'{label}', {priority if rank else repr(role)}"
        for role, labels in LABELS.items()
        for priority, label in enumerate(labels)
    ]
    return F.try_element_at(F.expr(f"map({', '.join(entries)})"), key)


def label_role(key: Column) -> Column:
    """Role of a label key (``seriesid`` -> ``series_id``), null for other texts."""
    return _label_lookup(key, rank=False)


def label_priority(key: Column) -> Column:
    return _label_lookup(key, rank=True)


# Integer codes let frequency facts stay in hash aggregation buffers.
FREQUENCY_CODES = {"annual": 1, "monthly": 2, "quarterly": 3}


def infer_frequency(dates: DataFrame, by: list[str]) -> DataFrame:
    """Frequency of each group of dated labels, as column ``inferred``.

    ``dates`` has ``period_date`` and ``period_frequency`` (what the label itself implies,
    or "unknown"). One implied frequency wins; otherwise the lower median of the month
    deltas between consecutive dates decides. Dates are first counted per month, so
    the window below sees at most one row per calendar month of a group however many
    dates it has; equal months contribute zero deltas through their count.
    """
    codes = " ".join(f"WHEN '{name}' THEN {code}" for name, code in FREQUENCY_CODES.items())
    code = F.expr(f"CASE period_frequency {codes} END")
    monthly = (
        dates.where(F.col("period_date").isNotNull())
        .select(*by, month_index(F.col("period_date")).alias("month"), code.alias("code"))
        .groupBy(*by, "month")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("code").alias("low"),
            F.max("code").alias("high"),
        )
    )
    step = F.lead("month").over(W.partitionBy(*by).orderBy("month")) - F.col("month")

    def deltas_below(limit: int) -> Column:
        """Number of deltas below a positive limit; repeats inside a month are zeros."""
        return F.sum(F.col("n") - 1 + F.when(F.col("step") < limit, 1).otherwise(0))

    facts = (
        monthly.withColumn("step", step)
        .groupBy(*by)
        .agg(
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            (F.sum("n") - 1).alias("total"),
            *[deltas_below(m).alias(f"below_{m}") for m in (1, 2, 3, 4, 12, 13)],
        )
    )
    implied = " ".join(f"WHEN {code} THEN '{name}'" for name, code in FREQUENCY_CODES.items())
    medians = " ".join(
        f"WHEN below_{m} < ceil(total / 2) AND ceil(total / 2) <= below_{m + 1} THEN '{name}'"
        for m, name in ((1, "monthly"), (3, "quarterly"), (12, "annual"))
    )
    frequency = F.expr(
        f"CASE WHEN low = high THEN CASE low {implied} END "
        f"WHEN total < 1 THEN 'unknown' {medians} ELSE 'unknown' END"
    )
    return facts.select(*by, frequency.alias("inferred"))


def best_date_row(cells: DataFrame) -> DataFrame:
    """Row with the most period cells per sheet, the upper one on ties."""
    return _best_line(with_periods(cells), "row_no")


def best_date_column(cells: DataFrame) -> DataFrame:
    """Column with the most period cells per sheet, the left one on ties."""
    return _best_line(with_periods(cells), "col_no")


def _best_line(cells: DataFrame, axis: str) -> DataFrame:
    return (
        cells.where(F.col("period_date").isNotNull())
        .groupBy(*SHEET, axis)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*SHEET)
        .agg(F.max(F.struct("n", (-F.col(axis)).alias("up"))).alias("best"))
        .select(*SHEET, (-F.col("best.up")).alias(axis), F.col("best.n").alias("n_dates"))
    )
