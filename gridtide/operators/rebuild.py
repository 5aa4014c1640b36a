"""Rebuild of the file and release index from landed pages, in a table that stays readable.

Pages land again and again; the newest landing of each address counts. What is found for the
catalogues that are refreshed is written to a folder of its own version, and only then does a
row per catalogue in the table of versions point to it. Readers take the newest version of each
catalogue, so they see all of a refresh or nothing of it, a refresh that dies is never seen, and
a catalogue that has lost its files has none.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridtide.operators.discovery import discover_files, discover_releases
from gridtide.schemas import FILE_INDEX, RELEASES
from gridtide.sources.inventory import stored_table
from gridtide.sources.pages import page_outlines
from gridtide.staging import spread, stage

VERSIONS = "cat_no STRING, version STRING, committed BIGINT"
TABLES = {"files": FILE_INDEX, "releases": RELEASES}


def newest_landings(pages: DataFrame, landed: str | Column = "landed") -> DataFrame:
    """The newest page of each ``url`` (by ``landed``, then ``page_id``); the texts of pages are
    not moved to find it."""
    when = F.col(landed) if isinstance(landed, str) else landed
    newest = pages.groupBy("url").agg(
        F.max(F.struct(when.alias("landed"), "page_id"))["page_id"].alias("page_id")
    )
    return pages.join(newest.select("page_id"), "page_id", "left_semi")


def refresh_index(
    spark: SparkSession, pages: DataFrame, seeds: DataFrame, base_url: str, store: str,
    landed: str | Column = "landed",
) -> str:
    """Discover files and releases of the catalogues in ``seeds`` and swap them in ``store``.

    Other catalogues of the store stay as they are. Returns the name of the version.
    """
    version = uuid.uuid4().hex
    # found, moved and parsed once for all that reads them
    current = stage(newest_landings(pages, landed).select("page_id", "url", "html"), "newest-pages")
    outlines = stage(page_outlines(spread(current)), "outlines")
    found = {
        "files": discover_files(current, seeds, base_url, outlines),
        "releases": discover_releases(current, seeds, base_url, outlines),
    }
    for name, rows in found.items():
        rows.select(*TABLES[name].names).write.parquet(f"{store}/{name}/version={version}")
    _commit(seeds, store, version)
    return version


def _commit(seeds: DataFrame, store: str, version: str) -> None:
    """Point the refreshed catalogues to their new version, in one append."""
    rows = seeds.select("cat_no").distinct().select(
        "cat_no", F.lit(version).alias("version"),
        F.lit(time.time_ns() // 1000).cast("bigint").alias("committed"),
    )
    rows.coalesce(1).write.mode("append").parquet(f"{store}/versions")


def current_versions(spark: SparkSession, store: str) -> DataFrame:
    """(cat_no, version): the newest version of each catalogue."""
    rows = stored_table(spark, f"{store}/versions", VERSIONS)
    newest = F.max(F.struct("committed", "version"))["version"].alias("version")
    return rows.groupBy("cat_no").agg(newest)


def stored_rows(spark: SparkSession, store: str, name: str = "files") -> DataFrame:
    """Current rows of the "files" or "releases" of a store; versions that no catalogue points
    to any more are not read."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES[name])
    rows = stored_table(spark, f"{store}/{name}", f"{schema}, version STRING")
    current = current_versions(spark, store)
    return rows.join(current, ["version", "cat_no"], "left_semi").select(*TABLES[name].names)
