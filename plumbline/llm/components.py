"""Connected components of an edge table by alternating large and small stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import drop, table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least.select(F.col("u").alias("w"), "m"), F.col("u") == F.col("w")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.union(least.select("u", F.col("m").alias("v")))


def stars(edges: DataFrame) -> DataFrame:
    """(u, v) links of long ids, in any direction and repeated at will -> (u, v) with v the smallest id of u's component.

    Ids that are smallest in their component, and ids without links, are not returned. Rounds grow with the
    logarithm of the longest chain; each round is written to the shared folder.
    """
    now = table(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        before, now = now, table(_small_star(_large_star(now).distinct()).distinct(), "edges")
        drop(before)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == tuple(seen):
            return now
        state = tuple(seen)
