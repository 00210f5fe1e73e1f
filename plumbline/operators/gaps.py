"""Gaps in what a feed has: ranges of time without items, to be read again."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def gaps(items: DataFrame, shard: str, time: str, most: int) -> DataFrame:
    """(shard, after, before): neighbouring items of a shard more than ``most`` seconds apart, and what lies before its first
    (after is null) and beyond its last (before is null).

    Items are first folded to the first and last of each ``most`` seconds, on the map side; a gap never lies within
    one such stretch, so the window has as many rows as there are stretches, however many items a shard has.
    """
    rows = items.select(F.col(shard).alias("shard"), F.col(time).cast("long").alias("t")).filter("shard is not null and t is not null")
    some = rows.groupBy("shard", F.floor(F.col("t") / most).alias("s")).agg(F.min("t").alias("first"), F.max("t").alias("last"))
    order = Window.partitionBy("shard").orderBy("s")
    some = some.withColumn("after", F.lag("last").over(order)).withColumn("next", F.lead("first").over(order))
    inner = some.filter(F.col("after").isNull() | (F.col("first") - F.col("after") > most)).select("shard", "after", F.col("first").alias("before"))
    return inner.unionByName(some.filter("next is null").select("shard", F.col("last").alias("after"), F.lit(None).cast("long").alias("before")))


def merged(ranges: DataFrame) -> DataFrame:
    """(shard, after, before): requested ranges that touch or overlap as one."""
    order = Window.partitionBy("shard").orderBy("after", "before")
    so_far = F.max("before").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce((F.col("after") > so_far).cast("int"), F.lit(1))
    rows = ranges.filter("shard is not null and after < before").withColumn("_b", begins)
    return rows.withColumn("_n", F.sum("_b").over(order)).groupBy("shard", "_n").agg(F.min("after").alias("after"), F.max("before").alias("before")).drop("_n")


def to_read(items: DataFrame, requested: DataFrame, shard: str, time: str, most: int) -> DataFrame:
    """(shard, after, before): the parts of the requested ranges in which more than ``most`` seconds have no item.

    Ranges are open: an item at either end is there already. A shard without items is read as requested.
    """
    asked = merged(requested.select("shard", F.col("after").cast("long").alias("after"), F.col("before").cast("long").alias("before")))
    wide = asked.select("shard", F.col("after").alias("lo"), F.col("before").alias("hi"))
    holes = wide.join(gaps(items, shard, time, most), "shard", "left")
    clipped = holes.select("shard", F.greatest("lo", "after").alias("after"), F.least("hi", "before").alias("before"))  # nulls don't count
    return clipped.filter(F.col("before") - F.col("after") > most)


def as_option(ranges: DataFrame) -> str:
    """Ranges as the option ``ranges`` of the paged source; as many as there are gaps to repair."""
    return json.dumps(sorted([r["after"], r["before"]] for r in ranges.select("after", "before").collect()))
