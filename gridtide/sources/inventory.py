"""Stored files and index tables: inventory, file index, release index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridtide.schemas import FILE_INDEX, RELEASES


def source_kind(path: Column, root: Column | str) -> Column:
    """First folder of a path below the root, "other" for files directly in it."""
    root = F.lit(root) if isinstance(root, str) else root
    below = F.substr(path, F.length(root) + F.lit(1))
    rest = F.ltrim(below, F.lit("/"))
    return F.when(rest.contains("/"), F.substring_index(rest, "/", 1)).otherwise("other")


def source_inventory(manifest: DataFrame, root: str) -> DataFrame:
    """kind, file, path, size and modified of each stored file; order is left to the caller.

    ``manifest`` has the metadata columns of a binaryFile scan.
    """
    return manifest.select(
        source_kind(F.col("path"), root).alias("kind"),
        F.substring_index("path", "/", -1).alias("file"),
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """Inventory of everything below a folder; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    qualified = files.select(
        F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", "modificationTime"
    )
    return source_inventory(qualified, root)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """File index from a JSON array file or a Parquet table.

    Rows of older indexes without a table title take the file title.
    """
    if path.endswith(".json"):
        rows = spark.read.schema(FILE_INDEX).option("multiLine", "true").json(path)
    else:
        rows = spark.read.schema(FILE_INDEX).parquet(path)
    return rows.withColumn("table_title", F.coalesce("table_title", "file_title"))


def read_releases(spark: SparkSession, path: str) -> DataFrame:
    """Release index from JSON; rows whose release date is no ISO date are left out."""
    text = "cat_no STRING, title STRING, release_date STRING, release_url STRING"
    rows = spark.read.schema(text).option("multiLine", "true").json(path)
    iso = F.when(
        F.col("release_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
        F.col("release_date").try_cast("date"),
    )
    dated = rows.withColumn("release_date", iso).where(F.col("release_date").isNotNull())
    return dated.select(*RELEASES.names)


def stored_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table; empty where nothing was stored yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def write_index(index: DataFrame, path: str) -> None:
    """Store a file index, replacing the catalogues and releases it contains."""
    _overwrite(index, path, ["cat_no", "release_date"])


def write_releases(releases: DataFrame, path: str) -> None:
    _overwrite(releases, path, ["cat_no"])


def _overwrite(rows: DataFrame, path: str, by: list[str]) -> None:
    # One file per partition value, except that a large catalogue keeps several.
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def read_stored_index(spark: SparkSession, path: str) -> DataFrame:
    """File index written by :func:`write_index`."""
    rows = spark.read.schema(FILE_INDEX).parquet(path)
    return rows.withColumn("table_title", F.coalesce("table_title", "file_title"))


def with_seeds(index: DataFrame, seed_index: DataFrame) -> DataFrame:
    """Index completed by the seed rows of catalogues it does not hold."""
    missing = seed_index.join(index.select("cat_no").distinct(), "cat_no", "left_anti")
    return index.unionByName(missing.select(*index.columns))


def json_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Landed JSON files as ``doc_id`` (the path) and ``json`` (the text)."""
    rows = spark.read.text(paths, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("json"))
