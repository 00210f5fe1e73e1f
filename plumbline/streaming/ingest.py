"""Structured Streaming: files into a keyed table, process-once selection, windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from plumbline.operators.upsert import OLD, SnapshotTable, last_wins


def files(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", per_batch: int = 1000, archive: str | None = None) -> DataFrame:
    """Files as they arrive; done ones may be moved to an archive."""
    reader = spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def upsert_stream(stream: DataFrame, table: str, checkpoint: str, key: Sequence[str], order: Sequence[str], rules: dict[str, str], default: str = OLD, prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Merge each micro-batch into a snapshot table; at least once, and idempotent, so effectively once."""

    def merge(batch: DataFrame, _: int) -> None:
        rows = prepare(batch) if prepare else batch
        SnapshotTable(batch.sparkSession, table).merge(last_wins(rows, key, order), key, rules, default)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once(stream: DataFrame, key: Sequence[str], at: str, delay: str) -> DataFrame:
    """Each key once; keys are remembered for ``delay`` of event time."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(key))


def windowed(stream: DataFrame, at: str, by: str, size: str, delay: str) -> DataFrame:
    """Counts per window and kind; windows close ``delay`` after their end."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, size), by).agg(F.count("*").alias("n"))
