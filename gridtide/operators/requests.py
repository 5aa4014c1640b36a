"""From a request (catalogue, file, release) to observations and cubes.

The index rows that answer the requests are few; they are joined to the cells by source file, so
only the cells of chosen files go on. Where the cells are stored by source file, Spark prunes
their partitions at run time with what the index answers. Every row then carries the provenance
of its own index row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.operators.catalogue import family_request, select_files
from gridtide.operators.cubes import read_cube
from gridtide.operators.tables import cells_of_tables
from gridtide.operators.timeseries import tidy
from gridtide.staging import stage

PROVENANCE = ["cat_no", "release_date", "file_title", "filename"]
Tables = str | int | Sequence[str | int]


def chosen_files(index: DataFrame, requests: DataFrame, source: Column | None = None) -> DataFrame:
    """(request_id, source_file, provenance, error): the file of each request. ``source`` is the
    name of a file among the cells, by default that in the index."""
    chosen = select_files(index, requests)
    name = F.col("filename") if source is None else source
    return chosen.select("request_id", name.alias("source_file"), *PROVENANCE, "error")


def cells_of_files(cells: DataFrame, files: DataFrame) -> DataFrame:
    """Cells of the files named by ``source_file``."""
    wanted = files.where("source_file is not null").select("source_file").distinct()
    return cells.join(wanted, "source_file", "left_semi")


def _given(name: str, found: Column) -> Column:
    """What the index says, else what the sheet says."""
    stated = F.trim(F.col(f"of.{name}"))
    return F.coalesce(F.when(stated != "", stated), found)


def read_requests(
    cells: DataFrame, index: DataFrame, requests: DataFrame, tables: Tables | None = None,
    source: Column | None = None, strict: bool = False, **options,
) -> DataFrame:
    """Observations of the files that answer ``requests`` (see :func:`catalogue.select_files`).

    Each observation comes with ``request_id`` of every request that its file answers, and with
    catalogue and release of the index row. Requests without a file give nothing; ``strict``
    raises with their reasons instead. ``tables`` keeps the sheets that answer one of these.
    Other options are those of :func:`timeseries.tidy`.
    """
    files = stage(chosen_files(index, requests, source), "chosen-files")
    if strict:
        _require(files)
    some = stage(cells_of_files(cells, files), "chosen-cells")
    if tables is not None:
        some = cells_of_tables(some, tables)
    found = tidy(some, **options)
    named = files.where("error is null").select("request_id", "source_file", "cat_no", "release_date")
    joined = found.alias("o").join(named.alias("of"), "source_file")
    own = {name: _given(name, F.col(f"o.{name}")) for name in ("cat_no", "release_date")}
    rest = [own.get(name, F.col(f"o.{name}")).alias(name) for name in found.columns if name != "source_file"]
    return joined.select("request_id", "source_file", *rest)


def read_requested_cubes(
    cells: DataFrame, index: DataFrame, requests: DataFrame, family: str = "auto",
    source: Column | None = None, strict: bool = False,
) -> DataFrame:
    """Cubes of the files that answer ``requests``, each row with the provenance of its file:
    catalogue, release, file name (``cube``) and title of the index row."""
    files = stage(chosen_files(index, requests, source), "chosen-files")
    if strict:
        _require(files)
    found = read_cube(stage(cells_of_files(cells, files), "chosen-cells"), family)
    named = files.where("error is null").select(
        "request_id", "source_file", "cat_no", "release_date",
        F.col("filename").alias("cube"), F.col("file_title").alias("cube_title"),
    )
    joined = found.drop("cat_no", "release_date", "cube", "cube_title").join(named, "source_file")
    return joined.select("request_id", *found.columns)


def read_family(
    cells: DataFrame, index: DataFrame, family: str, selector: Tables | None = None,
    release: str | None = None, source: Column | None = None,
) -> DataFrame:
    """Observations or cubes of a named family, latest release by default.

    For a time-series family ``selector`` names tables of its workbook, for a cube family the
    cube. Raises with the reason if there is no such file.
    """
    request, is_cube = family_request(index.sparkSession, family, selector, release)
    if is_cube:
        return read_requested_cubes(cells, index, request, source=source, strict=True).drop("request_id")
    found = read_requests(cells, index, request, selector, source, strict=True)
    return found.drop("request_id")


def _require(files: DataFrame) -> None:
    failed = files.where("error is not null")
    first = failed.select("request_id", "error").first()
    if first is not None:
        raise ValueError(f"{failed.count()} requests have no file; request {first[0]}: {first[1]}")
