import json

import pytest

from plumbline.sources.paged import PagedSource, pages

#: The service: three items a second, and one second with a hundred.
ITEMS = [{"id": f"i{t}-{k}", "created_utc": t} for t in range(1, 60) for k in range(100 if t == 30 else 3)]


def service(after, before, size):
    return [x for x in ITEMS if after < x["created_utc"] < before][:size]


def early():
    return 40


def late():
    return 59


@pytest.mark.parametrize("size", [1, 2, 3, 7, 500])
def test_ties_at_page_edges_come_once(size):
    got = [x["id"] for x in pages(service, 0, 100, size)]
    assert sorted(got) == sorted(x["id"] for x in ITEMS)
    assert [x["id"] for x in pages(service, 10, 12, size)] == [f"i11-{k}" for k in range(3)]


def test_batches_and_a_resumed_stream(spark, tmp_path):
    spark.dataSource.register(PagedSource)
    options = {"transport": "tests.test_paged:service", "size": "10", "shards": "3"}
    got = spark.read.format("paged").options(now="tests.test_paged:early", after="5", **options).load().collect()
    assert sorted(r.id for r in got) == sorted(x["id"] for x in ITEMS if 5 < x["created_utc"] <= 40)
    assert all(json.loads(r.payload)["created_utc"] == r.time for r in got)
    out, check = f"file://{tmp_path}/out", f"file://{tmp_path}/check"
    for now in ("early", "early", "late"):
        s = spark.readStream.format("paged").options(now=f"tests.test_paged:{now}", **options).load()
        s.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == sorted(x["id"] for x in ITEMS)
