"""Connected components of links between numbered things, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridtide.staging import stage


def _state(links: DataFrame) -> tuple:
    # hashes are summed as decimals: a sum of longs may overflow
    row = links.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
    ).first()
    return row["n"], row["s"]


def _toward_least(both: DataFrame, own: bool) -> DataFrame:
    """Neighbours (b of a) get linked to the least of a and its neighbours."""
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a")
    if own:
        return moved.select(F.col("b").alias("x"), "m").unionByName(
            least.select(F.col("a").alias("x"), "m")
        )
    return moved.where("b > a").select(F.col("b").alias("x"), "m")


def components(links: DataFrame) -> DataFrame:
    """(node, root): each node of (a, b) with a root other than itself, and the least node of
    its component. Alternates large and small stars until nothing changes; each round is
    written, so that lost executors cost one round. A node with very many links is spread by
    partial aggregation and by Spark's splitting of skewed joins."""
    now = stage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b").distinct(),
        "links",
    )
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _toward_least(both, own=False).where("x != m").distinct()
        large = stage(large.select(F.col("x").alias("a"), F.col("m").alias("b")), "large-star")
        small = _toward_least(large, own=True).where("x != m").distinct()
        now = stage(small.select(F.col("x").alias("a"), F.col("m").alias("b")), "small-star")
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
