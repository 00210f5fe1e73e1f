"""Session settings and the folder for cut lineages."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators are tested with; a cluster's own settings win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build(name: str = "plumbline", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in (DEFAULTS | settings).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; only where it is unset, and on one machine, a temporary one."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("plumbline.shared", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("plumbline.shared", named)
    return named.rstrip("/")


_kept: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; what is written there goes when this process ends."""
    path = f"{shared_folder(spark)}/plumbline/{name}-{uuid.uuid4().hex}"
    _kept.append((spark, path))
    return path


@atexit.register
def _release() -> None:
    while _kept:
        spark, path = _kept.pop()
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session has gone already; the folder belongs to the cluster
            return


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and go on from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh path and go on from there: as ``cut``, in a fraction of the bytes."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
