"""Posts, comments and the trees they form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import cut


def stage_join(stage: DataFrame, posts: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Staged comments with the surrogate id of their post; those of unknown posts are dropped."""
    return stage.join(posts.select(natural, surrogate), natural)


def fix_parents(comments: DataFrame, natural: str = "reddit_id", parent: str = "parent_reddit_id", surrogate: str = "id") -> DataFrame:
    """parent_id from the natural id of the parent; a missing parent stays null."""
    known = comments.select(F.col(natural).alias("_natural"), F.col(surrogate).alias("parent_id"))
    return comments.drop("parent_id").join(known, F.col(parent) == F.col("_natural"), "left").drop("_natural")


def rebuild(comments: DataFrame, key: str, parent: str) -> DataFrame:
    """Each comment's root and depth (0 for a root), by doubling: rounds grow with the logarithm of the depth.

    Comments whose parent is unknown are roots; members of a cycle are not returned.
    """
    ids = comments.select(F.col(key).alias("k"), F.col(parent).alias("p"))
    known = ids.select(F.col("k").alias("p"))
    up = ids.join(known, "p", "left_semi").select("k", "p", F.lit(1).cast("bigint").alias("d"))
    roots = ids.join(up.select("k"), "k", "left_anti").select("k", F.col("k").alias("p"), F.lit(0).cast("bigint").alias("d"))
    state = cut(roots.select("k", "p", "d", F.lit(True).alias("done")).unionByName(up.select("k", "p", "d", F.lit(False).alias("done"))))
    for _ in range(state.count().bit_length() + 1):  # by then a path is longer than the table: what is left goes round
        open_ = state.filter("not done")
        if open_.isEmpty():
            break
        above = state.select(F.col("k").alias("p"), F.col("p").alias("p2"), F.col("d").alias("d2"), F.col("done").alias("done2"))
        moved = open_.join(above, "p").select("k", F.col("p2").alias("p"), (F.col("d") + F.col("d2")).alias("d"), F.col("done2").alias("done"))
        state = cut(state.filter("done").unionByName(moved))
    return state.filter("done").select(F.col("k").alias(key), F.col("p").alias("root"), F.col("d").alias("depth"))


def rebuild_sql(spark, view: str, key: str, parent: str) -> DataFrame:
    """The same by a recursive query, for trees of bounded depth."""
    return spark.sql(f"""
        with recursive tree(id, root, depth) as (
            select c.{key}, c.{key}, 0L from {view} c left anti join {view} p on c.{parent} = p.{key}
            union all
            select c.{key}, t.root, t.depth + 1 from {view} c join tree t on c.{parent} = t.id)
        select id as {key}, root, depth from tree""")
