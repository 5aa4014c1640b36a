"""Tables as sheets: turn DataFrames and CSV files into the long ``cells`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T, Window as W

from gridtide.functions.text import clean_text
from gridtide.schemas import CELLS


def cell(value: Column, kind: str) -> Column:
    """``struct<kind, text, num, date>`` of a value; kind is s, n, b or d."""
    return F.struct(
        F.lit(kind).alias("kind"),
        value.cast("string").alias("text"),
        (value.cast("double") if kind == "n" else F.lit(None).cast("double")).alias("num"),
        (value.cast("date") if kind == "d" else F.lit(None).cast("date")).alias("date"),
    )


def kind_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "n"
    if isinstance(data_type, T.BooleanType):
        return "b"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "d"
    return "s"


def as_cells(df: DataFrame) -> DataFrame:
    """Conform columns to the ``cells`` schema and drop blank cells."""
    columns = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        if f.name in df.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in CELLS
    ]
    return df.select(*columns).where(clean_text(F.col("text")).isNotNull())


def cells_from_wide(
    df: DataFrame,
    source_file: Column | str,
    sheet_no: Column | int,
    sheet: Column | str,
    row_no: Column,
    columns: list[str] | None = None,
    header: bool = True,
) -> DataFrame:
    """One cell per non-blank field; the column names become row 1 when ``header``.

    ``row_no`` is the 1-based position of a record inside its sheet.
    """
    names = columns or df.columns

    def lit(value):
        return value if isinstance(value, Column) else F.lit(value)

    keys = {"source_file": lit(source_file), "sheet_no": lit(sheet_no), "sheet": lit(sheet)}
    keyed = df.withColumns({f"_{k}": v for k, v in keys.items()}).withColumn("_row", row_no)

    def positioned(position: int, value: Column, kind: str) -> Column:
        body = cell(value, kind)
        return F.struct(F.lit(position).alias("col_no"), *[body[x].alias(x) for x in
                                                           ("kind", "text", "num", "date")])

    sheet_key = [F.col(f"_{k}").alias(k) for k in keys]
    kinds = {f.name: kind_of(f.dataType) for f in df.schema}
    fields = [(i, F.col(f"`{n}`"), kinds[n]) for i, n in enumerate(names, 1)]
    values = F.array(*[positioned(*field) for field in fields])
    shift = 1 if header else 0
    out = keyed.select(*sheet_key, (F.col("_row") + shift).alias("row_no"), F.inline(values))
    if header:
        titles = F.array(*[positioned(i, F.lit(n), "s") for i, n in enumerate(names, 1)])
        sheets = keyed.select(*sheet_key).distinct()
        out = sheets.select("*", F.lit(1).alias("row_no"), F.inline(titles)).unionByName(out)
    return as_cells(out)


def cells_from_csv(spark: SparkSession, paths: str | list[str], sheet: str = "csv") -> DataFrame:
    """CSV files as one-sheet workbooks; every field is a text cell.

    Row numbers come from the order inside each file: rows are counted per input split
    and each split is offset by the splits before it, so no file passes through one task.
    Empty lines do not count as rows.
    """
    # No line has more fields than commas plus one; columns too many stay empty.
    commas = F.max(F.size(F.split("value", ",")))
    width = spark.read.text(paths).agg(commas.alias("n")).first()["n"] or 1
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    rows = spark.read.schema(schema).csv(paths).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = rows.groupBy("_file", "_start").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first_id")
    )
    before = F.sum("_n").over(W.partitionBy("_file").orderBy("_start")) - F.col("_n")
    offsets = splits.withColumn("_before", before).drop("_n")
    numbered = rows.join(offsets, ["_file", "_start"])
    row_no = (F.col("_id") - F.col("_first_id") + F.col("_before") + 1)
    return cells_from_wide(
        numbered, F.col("_file"), 1, sheet, row_no, schema.names, header=False
    )
