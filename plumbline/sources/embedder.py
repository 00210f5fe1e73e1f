"""Embeddings behind an interface, with an offline embedder that hashes words."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.slices import in_slices

Embedder = Callable[[Sequence[str], int], np.ndarray]


def hashing(texts: Sequence[str], dims: int) -> np.ndarray:
    """Signed word counts by hash, at length one; the same on any machine."""
    out = np.zeros((len(texts), dims))
    for row, t in zip(out, texts, strict=True):
        for w in t.lower().split():
            h = zlib.crc32(w.encode())
            row[h % dims] += 1 if h & 0x80000000 else -1
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(length > 0, length, 1)


def embed(rows: DataFrame, text: Column, dims: int = 1024, embedder: Embedder = hashing, most_chars: int | None = 8000) -> DataFrame:
    """Rows with ``embedding``; a vector of another size than ``dims`` is an error. ``most_chars`` None embeds whole texts."""

    @F.arrow_udf("array<float>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = np.empty((len(batch), dims), np.float32)
            for at, some in in_slices(batch):
                got = embedder(some.to_pylist(), dims)
                if got.shape[1] != dims:
                    raise ValueError(f"embedding has {got.shape[1]} dimensions, not {dims}")
                out[at : at + len(some)] = got
            ends = np.arange(0, out.size + 1, dims, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

    whole = F.coalesce(text, F.lit(""))
    return rows.withColumn("embedding", vectors(whole if most_chars is None else F.substring(whole, 1, most_chars)))


def priority_page(signals: DataFrame, n: int, most_attempts: int = 3) -> DataFrame:
    """The next n rows to embed: most important first; rows that failed too often are left out, not asked for again for ever."""
    from plumbline.functions.text import priority

    todo = signals.filter(F.col("embedding").isNull() & (F.coalesce("attempts", F.lit(0)) < most_attempts))
    return todo.orderBy(priority(F.col("score"), F.col("dup_count")).desc(), "id").limit(n)
