from pyspark.sql import functions as F

from plumbline.operators import upsert as U
from plumbline.streaming import ingest


def test_restarted_stream_gives_the_same_table(spark, tmp_path):
    src, table, check = (f"file://{tmp_path}/{x}" for x in ("in", "table", "check"))
    schema = "k long, seq long, v string"
    spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        s = ingest.files(spark, src, spark.createDataFrame([], schema).schema)
        ingest.upsert_stream(s, table, check, ["k"], ["seq"], {"v": U.NEW, "seq": U.NEW}).awaitTermination()
        return sorted(map(tuple, U.SnapshotTable(spark, table).read().collect()))

    assert run() == [(1, 2, "b"), (2, 1, "c")]
    assert run() == [(1, 2, "b"), (2, 1, "c")]
    spark.createDataFrame([(1, 1, "a"), (3, 1, "d"), (2, 5, "late")], schema).coalesce(1).write.mode("append").parquet(src)
    assert [r[0] for r in run()] == [1, 2, 3]


def test_windows_and_once(spark, tmp_path):
    src = f"file://{tmp_path}/e"
    spark.createDataFrame([("2024-01-01 00:01:00", "x", 1), ("2024-01-01 00:02:00", "x", 1), ("2024-01-01 00:20:00", "y", 2)], "t string, kind string, id int").withColumn("ts", F.to_timestamp("t")).write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = ingest.windowed(ingest.files(spark, src, schema), "ts", "kind", "10 minutes", "1 minute").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.kind, r.n) for r in spark.table("w").collect()) == [("x", 2), ("y", 1)]
    q = ingest.once(ingest.files(spark, src, schema), ["id"], "ts", "1 hour").writeStream.format("memory").queryName("o").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("o").count() == 2
