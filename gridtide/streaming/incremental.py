"""Ingest only what changed: fingerprints, anti-join, contents of pending files only.

A stored result is reused while the source (path, size, time) and the way it is read
(parser version, kind, options) stay the same. A changed source gets a new fingerprint;
what was stored for the old one stays in place.

Two steps, two scans. The first lists metadata only and is anti-joined with the manifest, a
table of its own with one row per ingested file. The second opens just the pending paths, some
at a time: a batch of files is parsed, its cells are written to a folder of their own, and only
then are its manifest rows appended. A batch that dies before that is not in the manifest: its
folder is never read, and its files are pending again. Files without cells and broken files
have manifest rows too, so they are not tried again until they change.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from itertools import batched

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from gridtide.operators.sheets import with_periods
from gridtide.schemas import CELLS
from gridtide.sources.inventory import stored_table
from gridtide.sources.workbooks import open_workbooks, parse_workbooks, workbook_files
from gridtide.staging import stage

PARSER_VERSION = "1"
PACKAGE_VERSION = "0.1.0"
# Files opened together: bounds what the driver names in one scan and what a crash costs.
BATCH_FILES = 5000
SOURCE = "path STRING, length BIGINT, modificationTime TIMESTAMP, fingerprint STRING"
# One row per ingested file: run (the call that read it), batch (folder of its cells), place in
# time, number of sheets and cells, first error.
MANIFEST = (
    "fingerprint STRING, path STRING, length BIGINT, modificationTime TIMESTAMP, run STRING, "
    "batch STRING, committed BIGINT, n_sheets BIGINT, n_cells BIGINT, n_errors BIGINT, error STRING"
)
STORED = (
    "source_file STRING, sheet_no INT, sheet STRING, row_no BIGINT, col_no INT, kind STRING, "
    "text STRING, num DOUBLE, date DATE, fingerprint STRING"
)


def options_text(options: Mapping[str, object]) -> str:
    return json.dumps(options, sort_keys=True, default=str)


def fingerprint(path: Column, size: Column, modified: Column, kind: str, options: str) -> Column:
    """Hex SHA-1 over the source and everything that decides how it is read."""
    parts = [
        path, size.cast("string"), F.unix_micros(modified).cast("string"),
        F.lit(PARSER_VERSION), F.lit(PACKAGE_VERSION), F.lit(kind), F.lit(options),
    ]
    return F.sha1(F.concat_ws("\n", *parts))


def with_fingerprint(
    manifest: DataFrame, kind: str = "cells", options: Mapping[str, object] | None = None
) -> DataFrame:
    """Manifest rows (binaryFile metadata columns) with their fingerprint."""
    mark = fingerprint(
        F.col("path"), F.col("length"), F.col("modificationTime").cast("timestamp"), kind,
        options_text(options or {}),
    )
    return manifest.withColumn("fingerprint", mark)


def pending_sources(manifest: DataFrame, ingested: DataFrame) -> DataFrame:
    """Sources whose fingerprint is not stored yet."""
    return manifest.join(ingested.select("fingerprint"), "fingerprint", "left_anti")


def manifest_of(spark: SparkSession, store: str) -> DataFrame:
    """The newest manifest row of each fingerprint."""
    rows = stored_table(spark, f"{store}/manifest", MANIFEST)
    names = [field.split()[0] for field in MANIFEST.split(", ")]
    newest = F.max_by(F.struct(*names), F.struct("committed", "batch")).alias("newest")
    return rows.groupBy(F.col("fingerprint").alias("key")).agg(newest).select("newest.*")


def ingest(
    spark: SparkSession,
    listing: DataFrame,
    open_files: Callable[[list[str]], DataFrame],
    store: str,
    options: Mapping[str, object] | None = None,
    refresh: bool = False,
    run: str | None = None,
    batch_files: int = BATCH_FILES,
) -> str:
    """Parse the files of ``listing`` whose fingerprint is not in the manifest of ``store``.

    ``listing`` has path, length and modificationTime; ``open_files`` gives (path, content) rows
    of the paths it is asked for. ``refresh`` parses all of them again. Returns the name of the
    run, which its manifest rows carry.
    """
    run = run or uuid.uuid4().hex
    names = [field.split()[0] for field in SOURCE.split(", ")]
    pending = with_fingerprint(listing.select(*names[:3]), options=options).distinct()
    if not refresh:
        pending = pending_sources(pending, manifest_of(spark, store))
    # written first: what is pending must not change while batches are committed
    todo: Iterator[Row] = stage(pending.select(*names), "pending").toLocalIterator()
    for some in batched(todo, batch_files):
        _ingest_batch(spark, list(some), open_files, store, run)
    return run


def _ingest_batch(
    spark: SparkSession, sources: list[Row], open_files: Callable[[list[str]], DataFrame],
    store: str, run: str,
) -> None:
    batch = uuid.uuid4().hex
    known = spark.createDataFrame(sources, SOURCE)
    cells, sheets = parse_workbooks(open_files([row["path"] for row in sources]))
    marks = known.select(F.col("path").alias("source_file"), "fingerprint")
    cells.join(marks, "source_file").write.parquet(f"{store}/cells/batch={batch}")
    facts = sheets.groupBy(F.col("source_file").alias("path")).agg(
        F.count("n_cells").alias("n_sheets"),
        F.sum("n_cells").alias("n_cells"),
        F.count("error").alias("n_errors"),
        F.min("error").alias("error"),
    )
    _commit(known.join(facts, "path", "left"), store, run, batch)


def _commit(read: DataFrame, store: str, run: str, batch: str) -> None:
    """Append the manifest rows of a batch whose cells are written."""
    names = [field.split()[0] for field in MANIFEST.split(", ")]
    rows = read.withColumns(
        {
            "run": F.lit(run),
            "batch": F.lit(batch),
            "committed": F.lit(time.time_ns() // 1000).cast("bigint"),
            "n_sheets": F.coalesce("n_sheets", F.lit(0).cast("bigint")),
            "n_cells": F.coalesce("n_cells", F.lit(0).cast("bigint")),
            "n_errors": F.coalesce("n_errors", F.lit(0).cast("bigint")),
        }
    )
    rows.select(*names).coalesce(1).write.mode("append").parquet(f"{store}/manifest")


def current_files(
    spark: SparkSession, listing: DataFrame, store: str,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Manifest rows of the files of ``listing`` as they are now."""
    marked = with_fingerprint(listing, options=options).select("fingerprint").distinct()
    return manifest_of(spark, store).join(marked, "fingerprint", "left_semi")


def current_cells(
    spark: SparkSession, listing: DataFrame, store: str,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Stored cells of the files of ``listing`` as they are now; other batches are not read."""
    files = current_files(spark, listing, store, options).select("batch", "fingerprint")
    stored = stored_table(spark, f"{store}/cells", f"{STORED}, batch STRING")
    found = stored.join(files, ["batch", "fingerprint"], "left_semi")
    return with_periods(found.select(*CELLS.names))


def ingest_workbooks(
    spark: SparkSession,
    paths: str | list[str],
    store: str,
    recursive: bool = False,
    refresh: bool = False,
) -> DataFrame:
    """Parse new and changed workbooks into ``store`` and return the current cells."""
    options = {"recursive": recursive}
    listing = workbook_files(spark, paths, recursive).drop("content")
    ingest(spark, listing, lambda some: open_workbooks(spark, some), store, options, refresh)
    return current_cells(spark, listing, store, options)
