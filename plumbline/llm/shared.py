"""What the corpus operators share: intermediate tables, Arrow slices, column picks."""

from __future__ import annotations

import atexit
import ctypes.util
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are worked on in slices of about this many bytes, to bound a worker's memory.
SLICE_BYTES = 1_500_000

_written: list[tuple[SparkSession, str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one only where it is unset, on one machine."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("plumbline.scratch", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("plumbline.scratch", root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; what is written there goes when this process ends."""
    path = f"{shared_root(spark)}/plumbline/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``table`` made, as soon as what was made of them is a table itself."""
    for df in tables:
        _delete(df.sparkSession, df._scratch)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    if (spark, path) in _written:
        _written.remove((spark, path))


@atexit.register
def release() -> None:
    """Delete the intermediate tables of this process."""
    while _written:
        try:
            _delete(*_written[-1])
        except Exception:  # the session has gone already; the folder belongs to the cluster
            return


def spare(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone, null texts as empty; other columns, whatever their names, are not read."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


#: Text bytes of a range of rows: the least, and the most however large the table is.
LEAST_BYTES, MOST_BYTES, RANGES = 4 << 20, 64 << 20, 50_000


def range_count(texts: DataFrame, column: str = "text") -> int:
    """In how many ranges of rows a table is dealt out, by the bytes of its texts; a small table gives each core one."""
    size = texts.agg(F.sum(F.octet_length(column))).first()[0] or 0
    each = min(max(size // RANGES, LEAST_BYTES), MOST_BYTES)
    return max(1, -(-size // each), min(texts.sparkSession.sparkContext.defaultParallelism, -(-size // (1 << 16))))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut batches into runs of rows with about ``most`` bytes of text each; texts come as UTF-8 bytes."""
    for batch in batches:
        texts = [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
        begin, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if held >= most or i + 1 == len(texts):
                yield batch.slice(begin, i + 1 - begin), texts[begin : i + 1]
                begin, held = i + 1, 0


def trim() -> None:
    """Give freed memory back to the system: workers live on for later stages."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    give = getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None
    if give:
        give(0)


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch, list[bytes]], pa.RecordBatch | None], schema: str, column: str = "text", most: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, column, most):
            out = work(part, texts)
            if out is not None and out.num_rows:
                yield out
        trim()

    return df.mapInArrow(run, schema)
