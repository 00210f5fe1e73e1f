"""Items packed into prompts in order, under a budget of characters, without cutting any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import cut

#: Items of a range at most, about; each range is put in order by one task.
RANGE = 200_000


def running_total(rows: DataFrame, order: Sequence[Column], size: str, to: str, ranges: int | None = None) -> DataFrame:
    """``rows`` with the sum of ``size`` up to and with each row in ``order``, which must be total.

    Rows are dealt into ranges of the order; each is summed alone, and what the ranges before it have is added, so
    no task has more than a range.
    """
    n = ranges or max(1, -(-rows.count() // RANGE))
    dealt = rows.repartitionByRange(n, *order) if n > 1 else rows.coalesce(1)
    dealt = cut(dealt.withColumn("_range", F.spark_partition_id()))  # ranges are sampled: a second run may cut elsewhere
    sums = dealt.groupBy("_range").agg(F.sum(size).alias("_sum"))
    before = sums.select("_range", F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.sum(size).over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.join(F.broadcast(before), "_range").withColumn(to, F.col("_before") + own).drop("_range", "_before")  # a row for each range


def header(themes: Sequence[str], most: int = 20) -> str:
    """What a prompt carries over from the runs before: the first themes, each once."""
    once = list(dict.fromkeys(t for t in themes if t))[:most]
    return "".join(f"{t}\n" for t in once)


def packed(rows: DataFrame, item: Column, order: Sequence[Column], budget: int, themes: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``rows`` with ``item`` and ``prompt``: the prompts' numbers from zero, in order.

    A prompt has whole items, a line break after each, and the themes, and is no longer than ``budget``. Items go by
    their running total in steps of the budget less the longest item: a prompt begins with the first item that ends
    beyond its step, so it holds a step and at most one item more.
    """
    sized = rows.withColumn("item", F.coalesce(item, F.lit(""))).withColumn("_size", F.char_length("item").cast("long") + 1)
    longest = sized.agg(F.max("_size")).first()[0] or 0
    step = budget - len(header(themes)) - longest
    if step <= 0:
        raise ValueError(f"an item of {longest} characters and the themes leave no room in {budget}")
    total = running_total(sized, order, "_size", "_total", ranges)
    return total.withColumn("prompt", F.floor((F.col("_total") - 1) / step).cast("long")).drop("_size", "_total")


def prompts(packed_rows: DataFrame, order: Sequence[Column], themes: Sequence[str] = ()) -> DataFrame:
    """(prompt, n_items, text): the texts to send; a group is no larger than the budget."""
    keys = [c.alias(f"k{i}") for i, c in enumerate(order)]
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*keys, F.col("item").alias("item")))), lambda x: F.concat(x["item"], F.lit("\n"))), "")
    return packed_rows.groupBy("prompt").agg(F.count("*").alias("n_items"), F.concat(F.lit(header(themes)), text).alias("text"))
