"""Sheets, indexes, documents and pages derived from the given tables.

The test tables hold no workbooks, so every query renders the shape its operator expects
from them inside Spark: the work grows with the tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridtide.operators.sheets import with_periods
from gridtide.sources.wide import as_cells, cell
from gridtide.staging import spread, stage

BASE_URL = "https://stats.example.org"
ORIGIN = 1990 * 12
SHEET = ["source_file", "sheet_no", "sheet"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for expensive row-wise work: small files are spread over all cores."""
    return spread(table(spark, sf_dir, name))


def month_of(date: Column) -> Column:
    return F.trunc(date, "month")


def month_no(month: Column) -> Column:
    """1 for January 1990, the position of a month in all derived sheets."""
    return (F.year(month) * 12 + F.month(month) - ORIGIN).cast("int")


def month_label(month: Column) -> Column:
    return F.date_format(month, "MMM-yyyy")


Cell = tuple[Column | int, Column | int, Column, str]


def part_cells(df: DataFrame, *cells: Cell) -> DataFrame:
    """The given (row, column, value, kind) cells for each row of ``df``."""

    def lit(x):
        return F.lit(x) if isinstance(x, int) else x

    bodies = []
    for row_no, col_no, value, kind in cells:
        body = cell(value, kind)
        bodies.append(
            F.struct(
                lit(row_no).cast("bigint").alias("row_no"), lit(col_no).cast("int").alias("col_no"),
                *[body[x].alias(x) for x in ("kind", "text", "num", "date")],
            )
        )
    return as_cells(df.select(*SHEET, F.inline(F.array(*bodies))))


def stored_cells(parts: list[DataFrame]) -> DataFrame:
    """The cells table as a reader would store it: written once, periods parsed."""
    return stage(with_periods(reduce(DataFrame.unionByName, parts)), "cells")


def flag_sheet(df: DataFrame, flag: str, source: str, prefix: str) -> DataFrame:
    """Sheet columns from a one-letter code: sheet numbers follow the alphabet."""
    number = F.ascii(flag) - F.ascii(F.lit("A")) + 1
    return df.withColumns(
        {
            "source_file": F.lit(source),
            "sheet_no": number.cast("int"),
            "sheet": F.concat(F.lit(prefix + " "), number.cast("string")),
        }
    )


def supplier_month_cells(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Time-down sheets: one per return flag, a row per ship month, a column per supplier."""
    line = table(spark, sf_dir, "lineitem")
    month = month_of(F.col("l_shipdate")).alias("month")
    totals = line.groupBy("l_returnflag", "l_suppkey", month).agg(
        F.sum("l_quantity").alias("quantity")
    )
    facts = flag_sheet(stage(totals, "facts"), "l_returnflag", "lineitem", "Table")
    row, col = month_no(F.col("month")) + 4, (F.col("l_suppkey") + 2).cast("int")
    dates = facts.select(*SHEET, "month").distinct()
    columns = facts.select(*SHEET, "l_suppkey").distinct()
    sheets = columns.select(*SHEET).distinct()
    key = F.lpad(F.col("l_suppkey").cast("string"), 7, "0")
    labels = [
        ("Series ID", F.concat(F.lit("S"), key)),
        ("Unit", F.lit("Items")),
        ("Frequency", F.lit("Monthly")),
        ("Data Item", F.concat(F.lit("Quantity ; Supplier "), F.col("l_suppkey").cast("string"))),
    ]
    return [
        part_cells(facts, (row, col, F.col("quantity"), "n")),
        part_cells(dates, (row, 1, month_label(F.col("month")), "s")),
        part_cells(sheets, *[(i, 1, F.lit(label), "s") for i, (label, _) in enumerate(labels, 1)]),
        part_cells(columns, *[(i, col, text, "s") for i, (_, text) in enumerate(labels, 1)]),
    ]


def priority_month_cells(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Time-across sheets: one per order status, a row per priority, a column per month."""
    orders = table(spark, sf_dir, "orders")
    month = month_of(F.col("o_orderdate")).alias("month")
    counts = orders.groupBy("o_orderstatus", "o_orderpriority", month).agg(
        F.count(F.lit(1)).alias("n")
    )
    facts = flag_sheet(stage(counts, "facts"), "o_orderstatus", "orders", "Orders")
    digit = F.substring("o_orderpriority", 1, 1)
    row = digit.cast("int") + 4
    rows = facts.select(*SHEET, "o_orderpriority").distinct()
    months = facts.select(*SHEET, "month").distinct()
    sheets = rows.select(*SHEET).distinct()
    title = F.concat(F.lit("Table "), F.col("sheet_no").cast("string"), F.lit(". Orders"))
    col = month_no(F.col("month")) + 3
    return [
        part_cells(
            sheets, (1, 1, title, "s"), (2, 1, F.lit("Released: March 2024"), "s"),
            (4, 1, F.lit("Series ID"), "s"), (4, 2, F.lit("Description"), "s"),
            (4, 3, F.lit("Unit"), "s"),
        ),
        part_cells(months, (4, col, month_label(F.col("month")), "s")),
        part_cells(
            rows, (row, 1, F.concat(F.lit("PRIO000"), digit), "s"),
            (row, 2, F.col("o_orderpriority"), "s"), (row, 3, F.lit("Orders"), "s"),
        ),
        part_cells(facts, (row, col, F.col("n"), "n")),
    ]


def nation_matrix_cells(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Labelled-matrix sheets: status and nation down, months across, a footer below."""
    line = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    by_supplier = line.groupBy(
        "l_returnflag", "l_linestatus", "l_suppkey", month_of(F.col("l_shipdate")).alias("month")
    ).agg(F.sum("l_quantity").alias("quantity"))
    by_nation = (
        by_supplier.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("l_returnflag", "l_linestatus", "s_nationkey", "month")
        .agg(F.sum("quantity").alias("quantity"))
    )
    facts = flag_sheet(stage(by_nation, "facts"), "l_returnflag", "matrix", "Flows")
    status_no = F.when(F.col("l_linestatus") == "F", 0).otherwise(1)
    row = F.col("s_nationkey") * 2 + status_no + 3
    rows = facts.select(*SHEET, "l_linestatus", "s_nationkey").distinct()
    months = facts.select(*SHEET, "month").distinct()
    sheets = rows.select(*SHEET).distinct()
    col = month_no(F.col("month")) + 2
    notes = sheets.select(
        "source_file", (F.col("sheet_no") + 100).alias("sheet_no"), F.lit("Notes").alias("sheet")
    )
    nation = F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))
    return [
        part_cells(
            sheets, (1, 1, F.lit("Detailed data cube"), "s"), (2, 1, F.lit("Status"), "s"),
            (2, 2, F.lit("Nation key"), "s"), (1000, 1, F.lit("Source: line items"), "s"),
            (1000, 4, F.lit(999), "n"), (1001, 1, F.lit("After the footer"), "s"),
        ),
        part_cells(months, (2, col, month_label(F.col("month")), "s")),
        part_cells(rows, (row, 1, F.col("l_linestatus"), "s"), (row, 2, nation, "s")),
        part_cells(facts, (row, col, F.col("quantity"), "n")),
        part_cells(notes, (1, 1, F.lit("Explanations"), "s"), (2, 2, F.lit("Jan-2024"), "s")),
    ]


def brand_sheet_cells(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Sheet-shaped cubes: one sheet per brand, one row per part."""
    part = table(spark, sf_dir, "part")
    number = F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int")
    parts = part.withColumns(
        {
            "source_file": F.lit("brands"),
            "sheet_no": number,
            "sheet": F.concat(F.lit("Cube "), number.cast("string")),
        }
    )
    sheets = parts.select(*SHEET).distinct()
    row = F.col("p_partkey") + 2
    return [
        part_cells(
            sheets, *[(1, i, F.lit(n), "s") for i, n in enumerate(["Part", "Type", "Size"], 1)]
        ),
        part_cells(
            parts, (row, 1, F.col("p_partkey"), "n"), (row, 2, F.col("p_type"), "s"),
            (row, 3, F.col("p_size"), "n"),
        ),
    ]


def supplier_label_cells(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Label-only sheets: one per nation, a column per supplier; a few without proper IDs."""
    supplier = table(spark, sf_dir, "supplier").withColumns(
        {
            "source_file": F.lit("suppliers"),
            "sheet_no": (F.col("s_nationkey") + 1).cast("int"),
            "sheet": F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")),
        }
    )
    sheets = supplier.select(*SHEET).distinct()
    col = (F.col("s_suppkey") + 2).cast("int")
    key = F.lpad(F.col("s_suppkey").cast("string"), 7, "0")
    prefix = F.when(F.col("s_acctbal") < 0, "draft-").otherwise("B")
    labels = [
        ("Series Number", F.concat(prefix, key)),
        ("Description", F.col("s_name")),
        ("Units", F.lit("Dollars")),
        ("Frequency", F.lit("Biannual")),
    ]
    return [
        part_cells(sheets, *[(i, 1, F.lit(label), "s") for i, (label, _) in enumerate(labels, 1)]),
        part_cells(supplier, *[(i, col, text, "s") for i, (_, text) in enumerate(labels, 1)]),
    ]


def customer_head_cells(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """One workbook per customer that tells catalogue, release and table, some right at the top,
    some below a long preface, above the dates."""
    customer = table(spark, sf_dir, "customer").withColumns(
        {
            "source_file": F.concat(F.lit("customers/"), F.col("c_custkey").cast("string")),
            "sheet_no": F.lit(1),
            "sheet": F.concat(F.lit("Table "), (F.col("c_custkey") + 1).cast("string")),
        }
    )
    cat_no = F.concat((F.col("c_nationkey") + 5000).cast("string"), F.lit(".0"))
    release = F.date_format(F.add_months(F.lit("2020-01-01").cast("date"), F.col("c_nationkey")),
                            "MMMM yyyy")
    labelled = customer.where(F.col("c_acctbal") >= 0)
    free = customer.where(F.col("c_acctbal") < 0)
    title = F.concat(F.lit("Table "), F.col("c_nationkey").cast("string"), F.lit("b. "),
                     F.col("c_mktsegment"))
    preface = F.when(F.col("c_custkey") % 3 == 0, 40).otherwise(0)
    return [
        part_cells(
            customer, (1, 1, F.lit("Statistics of customers"), "s"),
            (preface + 5, 2, F.col("c_name"), "s"), (preface + 6, 1, F.lit("Mar-2020"), "s"),
            (preface + 7, 1, F.lit("Released: January 1999"), "s"),
        ),
        part_cells(
            labelled, (preface + 2, 1, F.lit("Catalogue Number"), "s"), (preface + 2, 3, cat_no, "s"),
            (preface + 3, 1, F.lit("Release Date"), "s"), (preface + 3, 2, release, "s"),
            (preface + 4, 1, title, "s"),
        ),
        part_cells(
            free, (preface + 2, 2, F.concat(F.lit("Catalogue No: "), cat_no), "s"),
            (preface + 3, 1, F.concat(F.lit("Released: "), release), "s"),
        ),
    ]


def supplier_footer_cells(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """One workbook per supplier and a row per order, some of which read as footers."""
    totals = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"), F.max("l_tax").alias("tax")
    )
    rows = stage(totals, "facts")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    name = F.when(F.col("s_acctbal") < 0, "Notes ").otherwise("Supplier ")
    rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).withColumns(
        {
            "source_file": F.concat(F.lit("footers/"), F.col("l_suppkey").cast("string")),
            "sheet_no": F.lit(1),
            "sheet": F.concat(name, F.col("l_suppkey").cast("string")),
        }
    )
    sheets = rows.select(*SHEET).distinct()
    row = F.col("l_orderkey") + 2
    text = F.when((F.col("tax") >= 0.08) & (F.col("quantity") <= 2), "Source: orders").otherwise(
        F.when(F.col("quantity") == 50, "All cells in")
    )
    order = F.when((F.col("quantity") == 50) & (F.col("tax") == 0), "this table").otherwise(
        F.col("l_orderkey").cast("string")
    )
    titles = ["Remark", "Order", "Quantity"]
    # a second sheet in every workbook, nothing but notes, well below its top
    notes = sheets.select(
        "source_file", F.lit(2).alias("sheet_no"), F.concat(F.lit("More on "), "sheet").alias("sheet")
    )
    return [
        part_cells(notes, (8, 1, F.lit("Explanatory remarks"), "s"), (9, 1, F.lit("On quantities"), "s")),
        part_cells(sheets, *[(1, i, F.lit(n), "s") for i, n in enumerate(titles, 1)]),
        part_cells(rows, (row, 1, text, "s"), (row, 2, order, "s"), (row, 3, F.col("quantity"), "n")),
    ]


def part_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file index with one file per part; the brand is the catalogue."""
    part = table(spark, sf_dir, "part")
    number = F.lpad(F.regexp_extract("p_brand", "([0-9]+)$", 1), 2, "0")
    cat_no = F.concat(F.lit("62"), number, F.lit(".0"))
    month = F.add_months(F.lit("2020-01-01").cast("date"), F.col("p_size"))
    table_no = (F.col("p_partkey") % 9 + 1).cast("string")
    page = F.concat(F.lit(BASE_URL + "/"), F.col("cat_no"))
    return (
        part.select(
            "*", cat_no.alias("cat_no"), F.lower(F.date_format(month, "MMM-yyyy")).alias("release_date")
        )
        .withColumn("filename", F.concat_ws("_", "cat_no", F.concat("p_partkey", F.lit(".xlsx"))))
        .select(
            "p_partkey", "cat_no",
            F.concat("p_brand", F.lit(" statistics")).alias("title"),
            F.concat("p_type", F.lit(" parts")).alias("description"),
            page.alias("page_url"), "release_date",
            F.concat(F.lit("Table "), table_no, F.lit(". "), F.col("p_name")).alias("file_title"),
            F.concat_ws("/", page, "release_date", "filename").alias("url"),
            "filename", F.lit("xlsx").alias("file_type"), table_no.alias("table_no"),
            F.concat(F.lit("Table "), table_no, F.lit(". "), F.col("p_name")).alias("table_title"),
            (F.col("p_type") != "PROMO").alias("is_timeseries"),
            (F.col("p_type") == "PROMO").alias("is_cube"),
        )
    )


def supplier_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tidy observations: quantity per supplier, return flag and month."""
    line = table(spark, sf_dir, "lineitem")
    facts = line.groupBy(
        "l_returnflag", "l_linestatus", "l_suppkey", month_of(F.col("l_shipdate")).alias("date")
    ).agg(F.sum("l_quantity").alias("value"))
    cat_no = F.expr("CASE l_returnflag WHEN 'A' THEN '6401.0' WHEN 'N' THEN '6302.0' ELSE '6202.0' END")
    return facts.select(
        cat_no.alias("cat_no"),
        F.concat(F.lit("Table "), F.col("l_linestatus")).alias("sheet"),
        F.concat(F.lit("S"), F.lpad(F.col("l_suppkey").cast("string"), 7, "0")).alias("series_id"),
        "date", "value", "l_returnflag", "l_linestatus",
    )
