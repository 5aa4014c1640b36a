"""Work on tidy series: lookup, label splitting, latest dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.functions.text import strip

# Parts that stand for a total rather than a component.
AGGREGATE_PARTS = [
    "total", "totals", "all", "all groups", "all sectors", "all states",
    "all territories", "all industries", "all persons", "all employees",
]


def _id_key(series_id: Column) -> Column:
    return F.lower(strip(series_id.cast("string")))


def lookup_series(df: DataFrame, series_id: str | Sequence[str] | DataFrame) -> DataFrame:
    """Observations of the given series; identifiers match in any case.

    A DataFrame of identifiers (column ``series_id``) may be of any size; a typed list
    becomes a plain filter that reaches the scan.
    """
    if isinstance(series_id, DataFrame):
        wanted = series_id.select(_id_key(F.col("series_id")).alias("_id")).distinct()
        keyed = df.withColumn("_id", _id_key(F.col("series_id")))
        return keyed.join(wanted, "_id", "left_semi").drop("_id")
    ids = [series_id] if isinstance(series_id, str) else list(series_id)
    return df.where(_id_key(F.col("series_id")).isin([str(i).strip().lower() for i in ids]))


def series_parts(text: Column, remove_totals: bool = False) -> Column:
    """Components of a series label: split on ``;`` if present, else ``|``, else ``,``."""
    pieces = (
        F.when(text.contains(";"), F.split(text, ";"))
        .when(text.contains("|"), F.split(text, r"\|"))
        .otherwise(F.split(text, ","))
    )
    parts = F.filter(F.transform(pieces, strip), lambda part: part != "")
    if remove_totals:
        parts = F.filter(
            parts,
            lambda part: ~F.regexp_replace(F.lower(part), r"\s+", " ").isin(AGGREGATE_PARTS),
        )
    return parts


def separate_series(
    df: DataFrame,
    column: str = "series",
    names: Sequence[str] | None = None,
    remove_totals: bool = False,
    drop_missing: bool = False,
    width: int | None = None,
) -> DataFrame:
    """Split a series label column into one column per component.

    The number of components is that of the longest label; pass ``width`` to spare the
    aggregate that finds it. ``names`` must then have exactly that many entries.
    """
    if column not in df.columns:
        raise ValueError(f"column {column!r} was not found")
    if isinstance(names, str):
        raise ValueError("names must be a sequence of column names")
    parts = series_parts(F.col(column).cast("string"), remove_totals)
    if width is None:
        width = df.agg(F.coalesce(F.max(F.size(parts)), F.lit(0)).alias("n")).first()["n"]
        width = max(width, 0)
    if names is None:
        names = [f"{column}_part_{i}" for i in range(1, width + 1)]
    elif len(names) != width:
        raise ValueError(f"names must contain {width} entries; got {len(names)}")
    split = df.withColumn("_parts", parts)
    out = split.select(
        *[name for name in df.columns if name not in names],
        *[F.get("_parts", F.lit(i)).alias(name) for i, name in enumerate(names)],
    )
    return out.na.drop(subset=list(names)) if drop_missing and names else out


def latest_date(df: DataFrame, date: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """Latest non-missing date, overall or per group, as column ``latest_date``."""
    if date not in df.columns:
        raise ValueError(f"column {date!r} was not found")
    return df.groupBy(*by).agg(F.max(date).alias("latest_date"))


def period_range(
    df: DataFrame, start_period: str | None = None, end_period: str | None = None
) -> DataFrame:
    """Observations from ``start_period`` to ``end_period``, both included.

    Bounds are period labels such as ``2024``, ``2024-Q2`` or ``2024-05``; an end bound
    covers its whole period.
    """
    from gridtide.functions.periods import text_period

    def label(value: str) -> str:
        return "'" + value.replace("'", "") + "'"

    if start_period is not None:
        df = df.where(F.col("date") >= text_period(label(start_period))["date"])
    if end_period is not None:
        end = text_period(label(end_period))
        months = (
            F.when(end["frequency"] == "annual", 12)
            .when(end["frequency"] == "quarterly", 3)
            .when(end["frequency"] == "monthly", 1)
        )
        beyond = F.add_months(end["date"], months)
        df = df.where(F.coalesce(F.col("date") < beyond, F.col("date") <= end["date"]))
    return df
