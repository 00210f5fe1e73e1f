"""Token ids in Simple-8b files (operator 9).

A token file is a folder of Parquet parts. Each row is a chunk: whole documents, in order of
doc_id, with about ``CHUNK`` ids packed into Simple-8b words (see ``simple8b``). Columns:

    bucket, chunk   order of the chunks over the whole folder
    base            ids of the bucket before this chunk
    doc_ids, sizes  the documents of the chunk and how many ids each has, end id included
    first           first word of each block, unsigned 32 bits little-endian
    words           the words, 64 bits little-endian

Parquet parts are written by Spark, so lost executors are made good and any store will do.
Buckets are ranges of (doc_id, hash of the text) between sampled quantiles, so they hold
about the same number of rows however the ids are spread.

Null and empty texts have the end id alone. Rows with a null doc_id come first. Rows that
repeat a doc_id stay rows of their own, in the order of a hash of their texts. An empty table
makes a folder without rows; other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm import simple8b
from plumbline.llm.shared import range_count, slices, texts_of

END_ID, CHUNK = 2, 1 << 16
_CHUNK = "bucket long, chunk int, base long, doc_ids array<long>, sizes array<int>, first binary, words binary"


def _pack(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from plumbline.llm.bytebpe import encoder

        encode = encoder(path)
        bucket, chunk, base = TaskContext.get().partitionId(), 0, 0
        docs, sizes, held = [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal chunk, base
            if docs:
                ids = np.concatenate(held)
                words, first = simple8b.encode(ids)
                row = [[bucket], [chunk], [base], [list(docs)], [list(sizes)], [first.astype("<u4").tobytes()], [words.astype("<u8").tobytes()]]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, kinds, strict=True)], names=["bucket", "chunk", "base", "doc_ids", "sizes", "first", "words"])
                chunk, base = chunk + 1, base + len(ids)
                docs.clear(), sizes.clear(), held.clear()

        for part, texts in slices(batches):
            ids, counts = encode(texts)
            at, total = 0, sum(sizes)
            for d, n in zip(part.column("doc_id").to_pylist(), counts.tolist(), strict=True):
                if total >= CHUNK:
                    yield from flush()
                    total = 0
                docs.append(d)
                sizes.append(n + 1)
                held += [ids[at : at + n], np.array([END_ID], np.uint32)]
                at, total = at + n, total + n + 1
        yield from flush()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode every text and write the token file ``path``, in order of doc_id."""
    texts = texts_of(docs).withColumn("row", F.xxhash64("text"))
    dealt = texts.repartitionByRange(range_count(texts), "doc_id", "row").sortWithinPartitions("doc_id", "row", "text")
    dealt.mapInArrow(_pack(tokenizer), _CHUNK).write.parquet(path)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = simple8b.decode(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["first"], "<u4")).astype("<u4")
            size = np.array(row["sizes"], np.int64)
            end = np.cumsum(size)
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip((end - size).tolist(), end.tolist(), strict=True)]
            bucket = pa.array(np.full(len(size), row["bucket"]))
            yield pa.RecordBatch.from_arrays([bucket, pa.array(row["doc_ids"], pa.int64()), pa.array(row["base"] + end - size), pa.array(size), pa.array(crc, pa.int64())], names=["bucket", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a token file: where its ids start, how many it has, and their CRC-32."""
    chunks = spark.read.schema(_CHUNK).parquet(path)
    total = chunks.groupBy("bucket").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    rows = chunks.mapInArrow(_unpack, "bucket long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(total.select("bucket", before), "bucket").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _texts(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from plumbline.llm.bytebpe import encoder

        decode = encoder(tokenizer).tokenizer.decode
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.decode(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["first"], "<u4"))
                end = np.cumsum(row["sizes"])
                texts = [decode(ids[b - n : b - 1].tolist(), skip_special_tokens=False) for n, b in zip(row["sizes"], end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(texts)], names=["doc_id", "text"])

    return run


def read_texts(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """(doc_id, text) of a token file."""
    return spark.read.schema(_CHUNK).parquet(path).mapInArrow(_texts(tokenizer), "doc_id long, text string")
