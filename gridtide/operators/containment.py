"""Texts that contain other texts, by an inverted index of short parts.

A text contains a needle only if it contains all parts of the needle. Texts offer their parts of
up to three letters; a needle looks up the rarest of its parts only, and what is found there is
verified. Joins are by equality of parts, so nothing is compared with everything, and a part
that most texts have is never looked up unless it is all that the needle consists of. Parts no
needle has are dropped where they arise; the index, many times the size of what it is made of, is
never sent to all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.staging import stage

GRAM = 3


def _parts(text: Column, size: Column | int) -> Column:
    """Distinct parts of a text with ``size`` letters; none if it is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    pieces = F.transform(starts, lambda i: F.substring(text, i, size))
    return F.when(F.length(text) >= size, F.array_distinct(pieces)).otherwise(
        F.array().cast("array<string>")
    )


def containing(texts: DataFrame, needles: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text, needle) of all texts that contain a needle with the same keys.

    ``texts`` has the keys and ``text``, ``needles`` the keys and ``needle``; both are reduced to
    distinct rows first. Nulls and empty needles find nothing.
    """
    offered = texts.select(*keys, "text").where("text is not null").distinct()
    wanted = needles.select(*keys, "needle").where("needle != ''").distinct()
    size = F.least(F.length("needle"), F.lit(GRAM))
    asked = stage(wanted.withColumn("part", F.explode(_parts(F.col("needle"), size))), "needle-parts")
    every = F.flatten(F.array(*(_parts(F.col("text"), n) for n in range(1, GRAM + 1))))
    index = offered.withColumn("part", F.explode(every)).join(
        asked.select(*keys, "part").distinct(), [*keys, "part"], "left_semi"
    )
    counts = index.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("n"))
    # a part no text has leaves the needle without a match
    rated = asked.join(counts, [*keys, "part"], "left").groupBy(*keys, "needle").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "part")).alias("rarest")
    )
    looked_up = rated.where("rarest.n > 0").select(*keys, "needle", F.col("rarest.part").alias("part"))
    # Spark takes the exploded index for no larger than the texts, and would broadcast it
    return (
        index.hint("merge").join(looked_up, [*keys, "part"])
        .where(F.col("text").contains(F.col("needle")))
        .select(*keys, "text", "needle")
    )


def spread_join(many: DataFrame, few: DataFrame, key: str, limit: int) -> DataFrame:
    """Equi-join on ``key`` where single keys may hold a large share of ``many``.

    Keys are counted first. One with more than ``limit`` rows is cut into as many slices as it
    takes; its rows are dealt over them and its partners are repeated for each. Other keys have
    one slice and pay nothing.
    """
    counts = many.groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > limit).select(
        "hot_key", F.ceil(F.col("n") / F.lit(limit)).cast("int").alias("slices")
    )

    def sliced(df: DataFrame) -> DataFrame:
        joined = df.join(hot, F.col(key) == F.col("hot_key"), "left").drop("hot_key")
        return joined.withColumn("slices", F.coalesce("slices", F.lit(1)))

    dealt = F.pmod(F.xxhash64(*many.columns), F.col("slices")).cast("int")
    left = sliced(many).withColumn("slice", dealt).drop("slices")
    copies = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    right = sliced(few).withColumn("slice", copies).drop("slices")
    return left.join(right, [key, "slice"]).drop("slice")
