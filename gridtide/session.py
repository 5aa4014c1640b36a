"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Cells compress well on disk: judge broadcasts by a size closer to that in memory.
    "spark.sql.sources.fileCompressionFactor": "3.0",
}
# Small local data is still spread over the cores.
LOCAL_SETTINGS = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the one you are given."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("gridtide")
    for key, value in {**SETTINGS, **LOCAL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
