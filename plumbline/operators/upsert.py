"""Keyed writes: collapse a batch, merge it into a target by a rule per column, keep snapshots.

A merge is one shuffle by key: target and batch are tagged, unioned and aggregated, so a hot
key is combined on the map side and neither side has to fit in memory.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions.jsonx import shallow_merge

NEW, OLD, RICHER, MERGE = "new", "old", "richer", "merge"


def last_wins(batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order``."""
    rest = [c for c in batch.columns if c not in key]
    best = F.max(F.struct(*(F.col(c) for c in order), *(F.col(c) for c in rest if c not in order))).alias("_row")
    kept = batch.groupBy(*key).agg(best)
    return kept.select(*(F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in batch.columns))


def first_wins(batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in batch.columns if c not in key]
    best = F.min(F.struct(*(F.col(c) for c in order), *(F.col(c) for c in rest if c not in order))).alias("_row")
    return batch.groupBy(*key).agg(best).select(*(F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in batch.columns))


def insert_ignore(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of the batch whose key is new."""
    return batch.join(target.select(*key), list(key), "left_anti")


def _rule(rule: str, old: Column, new: Column, in_old: Column, in_new: Column) -> Column:
    if rule == OLD:
        return F.when(in_old, old).otherwise(new)
    if rule == RICHER:
        return F.coalesce(new, old)
    if rule == MERGE:
        return F.when(in_old & in_new, shallow_merge(old, new)).when(in_new, new).otherwise(old)
    return F.when(in_new, new).otherwise(old)


def upsert(target: DataFrame, batch: DataFrame, key: Sequence[str], rules: dict[str, str], default: str = OLD) -> DataFrame:
    """Target with the batch merged in. A column without a rule follows ``default``; a batch without the column leaves it.

    Both sides have each key once. Rules: ``new`` takes the batch's value, ``old`` keeps the first one,
    ``richer`` takes the batch's unless it is null, ``merge`` merges JSON objects.
    """
    rest = [c for c in target.columns if c not in key]
    side = lambda df, n: df.select(*key, F.struct(*(F.col(c) if c in df.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in rest)).alias("row"), F.lit(n).alias("n"))
    both = side(target, 0).unionByName(side(batch, 1)).groupBy(*key)
    merged = both.agg(F.any_value(F.when(F.col("n") == 0, F.col("row")), True).alias("o"), F.any_value(F.when(F.col("n") == 1, F.col("row")), True).alias("b"))
    in_old, in_new = F.col("o").isNotNull(), F.col("b").isNotNull()
    return merged.select(*(F.col(c) if c in key else _rule(rules.get(c, default) if c in batch.columns else OLD, F.col(f"o.{c}"), F.col(f"b.{c}"), in_old, in_new).alias(c) for c in target.columns))


def replace_stale(target: DataFrame, current: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of the target whose key still occurs; null keys stay."""
    missing = target.filter(F.greatest(*(F.col(k).isNull() for k in key)) if len(key) > 1 else F.col(key[0]).isNull())
    live = target.join(current.select(*key).dropna().distinct(), list(key), "left_semi")
    return live.unionByName(missing)


class SnapshotTable:
    """A keyed Parquet table in buckets by hash of its key; a version is a list of the folder that each bucket lies in.

    A merge reads and writes only the buckets that its batch has keys of, into a folder of its own, and then commits: the
    next version's file comes to be with all its content or not at all, and only if there is none of that number. A
    writer that finds the number taken merges again on top of what is there now, so writers at once lose nothing, and
    one that dies leaves the version before it. The last ``keep`` versions can be read; files that only older ones have
    are deleted, ``keep`` should exceed the commits that others make during one merge, or that merge begins anew more often.

    ``buckets`` is their number at first. Where a bucket has more than ``most_bytes`` on average the next merge rewrites the
    table in as many more as bring it to half of that, so a bucket stays a task's work however large the table gets.
    """

    #: How often a merge is begun anew because others were faster.
    TRIES = 20

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, keep: int = 2, most_bytes: int = 256 << 20):
        self.spark, self.path, self.buckets, self.keep, self.most_bytes = spark, path.rstrip("/"), buckets, keep, most_bytes
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, at: str) -> list[str]:
        where = self._fs_path(at)
        return [x.getPath().getName() for x in self._fs.listStatus(where)] if self._fs.exists(where) else []

    def _versions(self) -> list[int]:
        return sorted(int(x) for x in self._names(f"{self.path}/_versions") if x.isdigit())

    def version(self) -> int:
        """Number of the current version; 0 before the first."""
        return max(self._versions(), default=0)

    def _state(self, version: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/_versions/{version}", wholetext=True).first()[0])

    def _rows(self, state: dict, only: Sequence[int] | None = None) -> DataFrame:
        paths = [f"{self.path}/{folder}/_bucket={b}" for b, folder in state["at"].items() if only is None or int(b) in only]
        kind = StructType.fromJson(state["schema"])
        return self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)

    def read(self, version: int | None = None) -> DataFrame | None:
        v = self.version() if version is None else version
        return self._rows(self._state(v)) if v else None

    def _commit(self, version: int, state: dict) -> bool:
        """Whether the version could be had: its file is renamed, on local disks linked, from one that is whole, and never replaces another."""
        whole, to = f"{self.path}/_versions/_{uuid.uuid4().hex}", f"{self.path}/_versions/{version}"
        out = self._fs.create(self._fs_path(whole), True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if self._fs.getUri().getScheme() != "file":
            if self._fs.rename(self._fs_path(whole), self._fs_path(to)):
                return True
            self._fs.delete(self._fs_path(whole), False)
            return False
        local = lambda p: self.spark._jvm.java.io.File(self._fs_path(p).toUri().getPath()).toPath()
        try:
            self.spark._jvm.java.nio.file.Files.createLink(local(to), local(whole))
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            return False
        finally:
            self._fs.delete(self._fs_path(whole), False)

    def _put(self, rows: DataFrame, key: Sequence[str], n: int, base: int, state: dict, replaced: Sequence[int] | None) -> int | None:
        """Write rows that are all that the replaced buckets have (None: all buckets), on top of version ``base``; None if another was faster."""
        folder = f"v{base + 1}-{uuid.uuid4().hex}"
        to = f"{self.path}/{folder}"
        bucket = F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")
        rows.withColumn("_bucket", bucket).repartition("_bucket").write.partitionBy("_bucket").parquet(to)
        written = [x.partition("=")[2] for x in self._names(to) if x.startswith("_bucket=")]
        stay = {} if replaced is None else {b: u for b, u in state["at"].items() if int(b) not in replaced}
        size = self._fs.getContentSummary(self._fs_path(to)).getLength()
        size += state.get("bytes", 0) * len(stay) // max(len(state.get("at", ())), 1)  # about what stays
        now = {"schema": rows.schema.jsonValue(), "key": list(key), "buckets": n, "bytes": size, "at": stay | dict.fromkeys(written, folder)}
        if not self._commit(base + 1, now):
            self._fs.delete(self._fs_path(to), True)
            return None
        self._expire()
        return base + 1

    def _expire(self) -> None:
        old, live = self._versions()[: -self.keep], self._versions()[-self.keep :]
        used = {(b, at) for x in live for b, at in self._state(x)["at"].items()}
        for x in old:
            try:
                gone = self._state(x)["at"].items()
            except Exception:  # another writer has expired it
                continue
            for b, at in gone:
                if (b, at) not in used:
                    self._fs.delete(self._fs_path(f"{self.path}/{at}/_bucket={b}"), True)
            self._fs.delete(self._fs_path(f"{self.path}/_versions/{x}"), False)

    def _tried(self, attempt: Callable[[int], int | None]) -> int:
        """Attempts on top of the current version until one is committed; errors count if nobody else was faster."""
        for _ in range(self.TRIES):
            base = self.version()
            try:
                done = attempt(base)
            except Exception:
                if self.version() == base:
                    raise
                done = None  # files of a version that has expired meanwhile
            if done is not None:
                return done
        raise RuntimeError(f"{self.path}: other writers were faster {self.TRIES} times")

    def write(self, df: DataFrame, key: Sequence[str]) -> int:
        """Replace the whole table."""
        return self._tried(lambda base: self._put(df, key, self.buckets, base, {}, None))

    def merge(self, batch: DataFrame, key: Sequence[str], rules: dict[str, str], default: str = OLD) -> int:
        return self._tried(lambda base: self._merged(base, batch, key, rules, default))

    def _merged(self, base: int, batch: DataFrame, key: Sequence[str], rules: dict[str, str], default: str) -> int | None:
        if not base:
            return self._put(batch, key, self.buckets, 0, {}, None)
        state = self._state(base)
        n, kind = state["buckets"], StructType.fromJson(state["schema"])
        batch = batch.withColumns({k: F.col(k).cast(kind[k].dataType) for k in key})  # the hash goes by the type
        if state.get("bytes", 0) > n * self.most_bytes:
            return self._put(upsert(self._rows(state), batch, key, rules, default), key, -(-2 * state["bytes"] // self.most_bytes), base, state, None)
        touched = [r[0] for r in batch.select(F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")).distinct().collect()]  # n at most
        if not touched:
            return base
        return self._put(upsert(self._rows(state, touched), batch, key, rules, default), key, n, base, state, touched)
