"""Small intermediate tables, written once and read back.

Layout operators work in two passes: a first one finds the skeleton of each sheet (one
row per sheet, one per series), a second one streams the cells past it. The skeleton is
orders of magnitude smaller than the cells but feeds several joins, so it is written as
a Parquet table: lineage is cut, a lost executor costs nothing, and its true size decides
between a broadcast and a shuffled join.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_local_root: str | None = None


def staging_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a scratch folder where it is unset."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="gridtide-")
    return _local_root


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the staging folder and return a scan of it."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/gridtide/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once for each row.

    Spark moves a filter below the columns it names and puts their expressions into it, each as
    often as it is named. It does not move one below a generator, so a filter on these columns
    reads their values.
    """
    old = [name for name in df.columns if name not in columns]
    return df.withColumns(columns).select(*old, F.inline(F.array(F.struct(*columns))))


def spread(df: DataFrame) -> DataFrame:
    """Rows over at least as many partitions as there are cores.

    For expensive row-wise work on a plain scan (pages, JSON documents). A table with
    enough splits, as any large one has, is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
