"""Selection of sheets by name or table request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.functions.text import strip
from gridtide.operators.containment import containing, spread_join

# Sheets with one name or number that a task takes.
HOT_ROWS = 100_000
TABLE_TOKEN = r"[0-9]+[a-z]?"


def select_sheets(cells: DataFrame, sheets: str | Sequence[str] | None = None) -> DataFrame:
    """Cells of the named sheets; all of them by default."""
    if sheets is None:
        return cells
    return cells.where(F.col("sheet").isin([sheets] if isinstance(sheets, str) else list(sheets)))


def table_key(text: Column) -> Column:
    return F.regexp_replace(F.lower(strip(text)), r"\s+", "")


def table_matches(sheet: Column, request: Column) -> Column:
    """Whether a sheet name answers a table request.

    Equal keys match. A request with a number matches the sheets that contain exactly
    this number token ("1" is neither "10" nor "1a"); any other one matches as a part
    of the name. A blank request matches nothing.
    """
    sheet_key, request_key = table_key(sheet), table_key(request)
    number = F.regexp_extract(F.lower(request), TABLE_TOKEN, 0)
    tokens = F.regexp_extract_all(F.lower(sheet), F.lit(TABLE_TOKEN), 0)
    by_content = F.when(number != "", F.array_contains(tokens, number)).otherwise(
        sheet_key.contains(request_key)
    )
    return (request_key != "") & ((sheet_key == request_key) | by_content)


def match_tables(sheets: DataFrame, requests: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sheets matched by each request, from ``sheet`` and ``request`` columns.

    Equi-joins only: requests with a number meet sheets by number token and by key; other ones
    look names up by their rarest part. Names and tokens that more than ``hot_rows`` sheets share
    are dealt over several tasks.
    """
    asked = requests.select("request").distinct().withColumns(
        {
            "key": table_key(F.col("request")),
            "number": F.regexp_extract(F.lower("request"), TABLE_TOKEN, 0),
        }
    ).where(F.col("key") != "")
    named = sheets.withColumn("key", table_key(F.col("sheet")))
    by_key = spread_join(named, asked.drop("number"), "key", hot_rows).drop("key")
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("sheet"), F.lit(TABLE_TOKEN), 0))
    numbered = named.drop("key").withColumn("number", F.explode(tokens))
    numbers = asked.where(F.col("number") != "").drop("key")
    by_number = spread_join(numbered, numbers, "number", hot_rows).drop("number")
    words = asked.where(F.col("number") == "").drop("number")
    inside = containing(
        named.select(F.col("key").alias("text")), words.select(F.col("key").alias("needle")), []
    )
    answers = inside.join(words, inside["needle"] == words["key"]).select(
        F.col("text").alias("key"), "request"
    )
    by_word = spread_join(named, answers, "key", hot_rows).drop("key")
    names = [*sheets.columns, "request"]
    found = by_key.select(*names).unionByName(by_number.select(*names))
    return found.unionByName(by_word.select(*names)).distinct()


def cells_of_tables(cells: DataFrame, tables: str | int | Sequence[str | int]) -> DataFrame:
    """Cells of the sheets that answer at least one table request."""
    wanted = [tables] if isinstance(tables, (str, int)) else list(tables)
    hit = F.lit(False)
    for request in wanted:
        hit = hit | table_matches(F.col("sheet"), F.lit(str(request)))
    return cells.where(hit)


def require_tables(cells: DataFrame, tables: str | int | Sequence[str | int]) -> DataFrame:
    """As :func:`cells_of_tables`, but an error when none matches, which tells how many sheets
    there are and lists up to 50 of them."""
    found = cells_of_tables(cells, tables)
    if found.isEmpty():
        names = cells.select("sheet").distinct()
        listed = ", ".join(row["sheet"] for row in names.limit(50).collect())
        raise ValueError(
            f"no sheets matched tables {tables!r}; {names.count()} available sheets: {listed}"
        )
    return found
