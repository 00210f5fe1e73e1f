"""Ordered limits, work queues, process-once marks and appends.

Every limit has a total order, ties by key. What is limited is a top-k: Spark keeps k rows per
task and merges them, so no task orders a whole table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.upsert import insert_ignore


def newest(rows: DataFrame, at: str, n: int, key: Sequence[str]) -> DataFrame:
    """The n newest rows; those without a time come last."""
    return rows.orderBy(F.col(at).desc_nulls_last(), *key).limit(n)


def page_after(rows: DataFrame, key: str, last: int | None, n: int) -> DataFrame:
    """Keyset paging: the n rows that follow ``last`` by key."""
    rest = rows if last is None else rows.filter(F.col(key) > last)
    return rest.orderBy(key).limit(n)


def scanned(rows: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """A limit on the rows that a stage looks at, before its predicates, in order of key."""
    return rows.orderBy(*key).limit(n)


def claim(jobs: DataFrame, claimed: DataFrame, key: str, at: str, n: int = 1) -> DataFrame:
    """The oldest jobs that nobody has claimed."""
    return jobs.join(claimed.select(key), key, "left_anti").orderBy(at, key).limit(n)


def shard(name: Column, n: int) -> Column:
    """Which of n shards a name belongs to, by its MD5, so that any engine agrees."""
    return (F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("bigint") % n).cast("int")


def mark(processed: DataFrame, done: DataFrame, key: str, at: Column) -> DataFrame:
    """The table of processed keys with those of ``done`` added at a time; a key keeps its first time."""
    fresh = done.select(key).distinct().withColumn("processed_at", at)
    return processed.select(key, "processed_at").unionByName(insert_ignore(processed, fresh, [key]))


def unprocessed(rows: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    return rows.join(processed.select(key), key, "left_anti")


def append_once(target: DataFrame, chunks: DataFrame, key: Sequence[str]) -> DataFrame:
    """Append rows whose key is new: a rerun adds nothing. With no key it is a plain append."""
    return target.unionByName(insert_ignore(target, chunks, key) if key else chunks)


def in_batches(rows: DataFrame, order: Sequence[Column], size: int, most: int) -> DataFrame:
    """The first ``most`` rows by ``order`` with ``batch``: the first ``size`` are batch 0, and so on.

    ``most`` bounds what is ranked in one task.
    """
    top = rows.orderBy(*order).limit(most)
    return top.withColumn("batch", F.floor((F.row_number().over(Window.orderBy(*order)) - 1) / size).cast("int"))


def snapshot_states(jobs: DataFrame, results: DataFrame, key: str = "snapshot_id") -> DataFrame:
    """Jobs with ``state`` and the payload of those ready.

    ``results`` (key, status, n_records, payload) is what the latest poll of each job gave. A job without a result or
    not ready is pending; one that claims records but came empty is kept for the next poll; else it is ready.
    """
    polled = jobs.join(results, key, "left")
    blank = F.coalesce(F.trim("payload"), F.lit("")).isin("", "[]")
    state = F.when(F.coalesce("status", F.lit("pending")) != "ready", "pending").when(blank & (F.coalesce("n_records", F.lit(0)) > 0), "retry").otherwise("ready")
    return polled.withColumn("state", state)


def survivors(states: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The queue's next content: jobs that aren't ready."""
    return states.filter("state <> 'ready'").select(*columns)


def listing(entries: DataFrame, seeds: DataFrame, most: int) -> DataFrame:
    """(seed, video, at): flat listings one level deep. An entry is a video, or a list whose entries are videos.

    ``entries`` (parent, pos, id, kind) hold kind 'video' or 'list'; each seed gives its first ``most`` videos in order.
    """
    top = seeds.join(entries, seeds["seed"] == entries["parent"]).select("seed", F.col("pos").alias("p"), "id", "kind")
    direct = top.filter("kind = 'video'").select("seed", "p", F.lit(0).alias("q"), "id")
    inner = entries.filter("kind = 'video'").select(F.col("parent").alias("list"), F.col("pos").alias("q"), F.col("id").alias("video"))
    nested = top.filter("kind = 'list'").join(inner, F.col("id") == F.col("list")).select("seed", "p", "q", F.col("video").alias("id"))
    first = direct.unionByName(nested).groupBy("seed", "id").agg(F.min(F.struct("p", "q")).alias("o"))
    at = F.row_number().over(Window.partitionBy("seed").orderBy("o", "id"))
    return first.withColumn("at", at).filter(F.col("at") <= most).select("seed", F.col("id").alias("video"), "at")


def retried[T](call: Callable[[], T], tries: int = 3, wait: Callable[[int], float] = lambda i: 2.0 * (i + 1), sleep: Callable[[float], None] = time.sleep) -> T:
    """The result of ``call``, tried again after ``wait(i)`` seconds; the last error is raised. For clients inside a worker."""
    for i in range(tries):
        try:
            return call()
        except Exception:
            if i + 1 == tries:
                raise
            sleep(wait(i))
    raise ValueError("no tries")


def exponential(i: int) -> float:
    """Waits for a server that asks to slow down: 1, 2, 4, .. seconds, a minute at most."""
    return min(60.0, 2.0**i)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
