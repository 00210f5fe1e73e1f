from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.functions import vectors as V
from plumbline.operators import cluster, neighbors, rollup, statements, threads, tier0
from plumbline.operators import upsert as U


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_rules(spark):
    old = spark.createDataFrame([(1, "a", 1, '{"x":1}'), (2, "b", 2, None)], "k int, t string, n int, m string")
    new = spark.createDataFrame([(2, None, 5, '{"y":2}'), (3, "c", 6, None)], "k int, t string, n int, m string")
    got = U.upsert(old, new, ["k"], {"t": U.RICHER, "n": U.NEW, "m": U.MERGE})
    assert rows(got) == [(1, "a", 1, '{"x":1}'), (2, "b", 5, '{"y":"2"}'), (3, "c", 6, None)]
    assert rows(U.upsert(old, new.drop("t"), ["k"], {"n": U.NEW})) == [(1, "a", 1, '{"x":1}'), (2, "b", 5, None), (3, None, 6, None)]


def test_last_wins_and_insert_ignore(spark):
    b = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, None)], "k int, seq int, t string")
    assert rows(U.last_wins(b, ["k"], ["seq"])) == [(1, 2, "y"), (2, 1, None)]
    assert rows(U.first_wins(b, ["k"], ["seq"])) == [(1, 1, "x"), (2, 1, None)]
    first = U.insert_ignore(b.limit(0), U.last_wins(b, ["k"], ["seq"]), ["k"])
    assert first.count() == 2 and U.insert_ignore(first, b, ["k"]).count() == 0


def test_snapshots(spark, tmp_path):
    t = U.SnapshotTable(spark, f"file://{tmp_path}/t")
    assert t.read() is None
    t.merge(spark.createDataFrame([(1, 1)], "k int, n int"), ["k"], {"n": U.NEW})
    t.merge(spark.createDataFrame([(1, 7), (2, 2)], "k int, n int"), ["k"], {"n": U.NEW})
    assert t.version() == 2 and rows(t.read()) == [(1, 7), (2, 2)]


def test_snapshots_rewrite_touched_buckets_only(spark, tmp_path):
    t = U.SnapshotTable(spark, f"file://{tmp_path}/t", buckets=8)
    want = {i: 0 for i in range(40)}
    t.write(spark.createDataFrame(sorted(want.items()), "k long, n long"), ["k"])
    first = t._state(1)["at"]
    for step in range(2, 6):
        t.merge(spark.createDataFrame([(3, step), (100 + step, step)], "k int, n long"), ["k"], {"n": U.NEW})
        want |= {3: step, 100 + step: step}
        assert dict(map(tuple, t.read().collect())) == want
    assert sum(v.startswith("v1-") for v in t._state(5)["at"].values()) >= len(first) - 5  # the rest stays where it was
    assert t._versions() == [4, 5] and dict(map(tuple, t.read(4).collect())) == {k: min(n, 4) for k, n in want.items() if k != 105}
    folders = {p.name.partition("-")[0] for p in (tmp_path / "t").iterdir()}
    assert {"v1", "v4", "v5"} <= folders
    assert t.merge(spark.createDataFrame([], "k long, n long"), ["k"], {}) == 5


def test_writers_at_once_lose_nothing(spark, tmp_path):
    """Two threads add to the same keys and to their own, without a lock."""
    path = f"file://{tmp_path}/t"
    U.SnapshotTable(spark, path, buckets=3).write(spark.createDataFrame([(0, 0)], "k long, n long"), ["k"])

    def work(w):
        for step in range(2):
            U.SnapshotTable(spark, path, keep=20).merge(spark.createDataFrame([(100 + 10 * w + step, w), (w, step)], "k long, n long"), ["k"], {"n": U.NEW})

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(work, range(1, 3)))
    t = U.SnapshotTable(spark, path)
    assert t.version() == 5
    assert dict(map(tuple, t.read().collect())) == {0: 0} | {w: 1 for w in (1, 2)} | {100 + 10 * w + s: w for w in (1, 2) for s in range(2)}


def test_a_writer_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    t = U.SnapshotTable(spark, f"file://{tmp_path}/t", buckets=2)
    t.write(spark.createDataFrame([(1, 1)], "k long, n long"), ["k"])
    more = spark.createDataFrame([(1, 5), (2, 2)], "k long, n long")

    def dies(*_):
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(U.SnapshotTable, "_commit", dies)
        with pytest.raises(OSError):
            t.merge(more, ["k"], {"n": U.NEW})
    assert t.version() == 1 and rows(t.read()) == [(1, 1)]
    assert t.merge(more, ["k"], {"n": U.NEW}) == 2 and rows(t.read()) == [(1, 5), (2, 2)]
    assert not t._commit(2, {}) and rows(t.read()) == [(1, 5), (2, 2)]  # a number that is taken


def test_buckets_follow_the_bytes(spark, tmp_path):
    t = U.SnapshotTable(spark, f"file://{tmp_path}/t", buckets=2, most_bytes=2000)
    t.write(spark.range(3000).selectExpr("id as k", "cast(id * id as string) as n"), ["k"])
    grown = -(-2 * t._state(1)["bytes"] // 2000)
    t.merge(spark.createDataFrame([(1, "new")], "k long, n string"), ["k"], {"n": U.NEW})
    assert t._state(2)["buckets"] == grown > 2 and t.read().count() == 3000
    assert t.read().filter("k = 1").first().n == "new" and t.read(1).filter("k = 1").first().n == "1"


def test_stale_rows_go_and_null_keys_stay(spark):
    t = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(U.replace_stale(t, spark.createDataFrame([(2,), (None,)], "k int"), ["k"])) == [(2,), (None,)]


def test_funnel_stages(spark):
    long_ = "x" * 320
    posts = spark.createDataFrame([("p1", "s", "How do i do it", "y" * 90, 3), ("p2", "s", "t", "z" * 90, 99999), ("p3", "o", "t", long_, None)], "reddit_id string, subreddit string, title string, selftext string, score long").withColumn("created_utc", F.lit("2024-01-01").cast("timestamp"))
    kept = tier0.post_signals(posts)
    assert {r.source_id for r in kept.collect()} == {"p1", "p3"}  # engagement never gates
    comments = spark.createDataFrame([("c1", "p1", long_, 1), ("c2", "gone", long_, 1)], "reddit_id string, post_id string, body string, score long").withColumn("created_utc", F.lit(None).cast("timestamp"))
    assert [r.source_id for r in tier0.comment_signals(comments, posts).collect()] == ["c1"]
    new = tier0.insert_new(kept.limit(0), kept, kept)
    assert new.count() == 2 and tier0.insert_new(new, kept).count() == 0
    audit = tier0.audit(posts.select(F.lit("reddit_post").alias("source"), F.col("reddit_id").alias("source_id"), F.concat_ws(" ", "title", "selftext").alias("text"), "score"), kept)
    assert [(r.source_id, r.flags) for r in audit.collect()] == [("p2", ["NO-PATH"])]


def test_threads_and_cycles(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 99), (6, 5), (7, 8), (8, 7)], "k long, p long")
    assert rows(threads.rebuild(df, "k", "p")) == [(1, 1, 0), (2, 1, 1), (3, 1, 2), (4, 1, 3), (5, 5, 0), (6, 5, 1)]


def test_fold_is_sequential_not_transitive(spark):
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "vec_id long")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    folded = neighbors.fold(ids, pairs)
    counts = neighbors.fold_counts(ids.withColumn("dup_count", F.lit(1)), folded)
    assert {r.vec_id: (r.dup_count, r.is_duplicate) for r in counts.collect()} == {1: (3, False), 2: (1, True), 3: (1, True), 4: (1, False)}
    chain = spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a long, b long")
    assert rows(neighbors.fold(ids, chain)) == [(1, 1), (2, 1), (3, 3), (4, 3)]


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_against_a_loop(spark, seed):
    rng = np.random.default_rng(seed)
    n = 60
    pairs = {(int(min(a, b)), int(max(a, b))) for a, b in rng.integers(0, n, (110, 2)) if a != b}
    near = {i: {a + b - i for a, b in pairs if i in (a, b)} for i in range(n)}
    seeds, want = [], {}
    for i in range(n):
        s = [x for x in seeds if x in near[i]]
        want[i] = min(s) if s else i
        if not s:
            seeds.append(i)
    got = neighbors.fold(spark.createDataFrame([(i,) for i in range(n)], "vec_id long"), spark.createDataFrame(sorted(pairs), "a long, b long"))
    assert dict(map(tuple, got.collect())) == want


def test_neighbours_in_blocks(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((90, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = 1 - u @ u.T
    want = {(i, j) for i in range(90) for j in range(i + 1, 90) if d[i, j] < 0.5}
    assert {(r.a, r.b) for r in neighbors.exact_pairs(df, 0.5, block=20).collect()} == want
    got = neighbors.knn(df, df.filter("vec_id < 7"), 5, block=20).collect()
    assert {(r.query, r.neighbour) for r in got} == {(i, int(j)) for i in range(7) for j in [k for k in np.argsort(d[i]) if k != i][:5]}
    found = {(r.a, r.b) for r in neighbors.lsh_pairs(df, 0.5, bits=4, tables=30).collect()}
    assert found <= want and len(found) >= 0.95 * len(want)


@pytest.mark.parametrize("block", [neighbors.BLOCK, 60])
def test_registered_neighbours_are_nearly_all(spark, block, monkeypatch):
    """The registered query against the exact pairs; smaller blocks make more bits and tables, as larger tables do."""
    from plumbline.plans import vectors

    monkeypatch.setattr(neighbors.lsh_pairs, "__defaults__", (*neighbors.lsh_pairs.__defaults__[:-1], block))
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = {(r.a, r.b) for r in neighbors.exact_pairs(df, vectors.NEAR).collect()}
    found = [(r.a, r.b) for r in vectors.lsh_neighbours(spark, "/root/testdata/sf0.1").collect()]
    assert len(found) == len(set(found)) and set(found) <= want and len(found) >= 0.95 * len(want)


def test_top_neighbours_and_fold_over_approximate_pairs(spark):
    """The registered query's ranks against brute force over what was found, and its recall; the fold is that of its pairs."""
    from plumbline.plans import vectors

    sf = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    exact = {(r.a, r.b): r.distance for r in neighbors.exact_pairs(df, vectors.NEAR).collect()}
    got = vectors.ann_topk(spark, sf).collect()
    by: dict = {}
    for r in got:
        by.setdefault(r.seed, []).append((r.distance, r.neighbour, r.rank))
        assert exact[min(r.seed, r.neighbour), max(r.seed, r.neighbour)] == pytest.approx(r.distance, abs=1e-6)
    assert len(got) >= 0.95 * 2 * len(exact)
    for rows_ in by.values():
        assert [x[2] for x in sorted(rows_)] == list(range(1, len(rows_) + 1)) and len(rows_) <= 200
    pairs = {(min(r.seed, r.neighbour), max(r.seed, r.neighbour)) for r in got}
    less: dict = {}
    for a, b in pairs:
        less.setdefault(b, []).append(a)
    seeds, want = set(), {}
    for (i,) in sorted(df.select("vec_id").collect()):
        near = [a for a in less.get(i, ()) if a in seeds]
        want[i] = min(near) if near else i
        if not near:
            seeds.add(i)
    assert dict(map(tuple, vectors.fold_lsh(spark, sf).collect())) == want


def test_odd_vectors_have_no_neighbours(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((40, 128))
    x[20:] = x[:20] + 0.1 * rng.standard_normal((20, 128))
    rows_ = [(i, v.tolist()) for i, v in enumerate(x)] + [(None, x[0].tolist()), (100, None), (101, [1.0, 2.0]), (102, [0.0] * 128)]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<float>")
    got = {(r.a, r.b) for r in neighbors.lsh_pairs(df, 0.2).collect()}
    assert got == {(i, i + 20) for i in range(20)}
    assert neighbors.lsh_pairs(df.limit(0), 0.2).count() == 0


def shuffled(spark, work) -> int:
    """Records that the stages of ``work`` write for shuffles."""

    def stages() -> dict[int, int]:
        context, jvm = spark._jsc.sc(), spark._jvm
        context.listenerBus().waitUntilEmpty(30_000)
        found = context.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {(s := found.apply(i)).stageId(): s.shuffleWriteRecords() for i in range(found.size())}

    before = stages()
    work()
    return sum(n for i, n in stages().items() if i not in before)


def test_vectors_are_sent_to_as_many_tasks_however_many_there_are(spark):
    """at a wide distance every vector went to more tables, the more there were: to 8 at 10 000, 154 at 600 000."""
    x = np.random.default_rng(4).standard_normal((24_000, 32))
    for n in (8000, 24_000):
        df = spark.createDataFrame(pa.table({"vec_id": pa.array(np.arange(n)), "embedding": pa.array(list(x[:n].astype(np.float32)), pa.list_(pa.float32()))}))
        sent = shuffled(spark, lambda df=df: neighbors.lsh_pairs(df, 0.6).write.format("noop").mode("overwrite").save())
        assert sent <= (neighbors.BLOCKS + 1) * n
    for n in (10_256, 102_564, 615_384):
        block = neighbors.block_rows(n, 64)
        assert neighbors.lsh_bits(n, 0.6, 0.98, block) == 0 and -(-n // block) == neighbors.BLOCKS
    assert neighbors.lsh_bits(10**8, 0.6, 0.98, neighbors.block_rows(10**8, 64)) > 8  # where tables cost less, there are some
    assert neighbors.lsh_bits(10**5, 0.05, 0.98, neighbors.block_rows(10**5, 64)) > 0


@pytest.mark.parametrize("bits", [None, 5])
def test_pairs_with_copies_zeros_and_repeated_ids(spark, bits, monkeypatch):
    """Against brute force, in small blocks and tiles: exact without tables, with tables nearly all and each once."""
    monkeypatch.setattr(neighbors, "_TILE", (8, 16))
    monkeypatch.setattr(neighbors, "_AT_ONCE", 1000)
    rng = np.random.default_rng(6)
    x = rng.standard_normal((260, 12))
    x[100:130] = x[99]  # copies
    x[130:140] = 0
    x[140:150] = x[140:150] * 1e20  # of any length
    ids = np.arange(260)
    u = x / np.where((length := np.linalg.norm(x, axis=1, keepdims=True)) > 0, length, 1)
    d = 1 - u @ u.T
    want = {(i, j) for i in range(260) for j in range(i + 1, 260) if d[i, j] < 0.5}
    df = spark.createDataFrame(list(zip(ids.tolist(), x.tolist(), strict=True)), "vec_id long, embedding array<double>")
    got = neighbors.lsh_pairs(df, 0.5, bits=bits, block=40).collect()
    found = [(r.a, r.b) for r in got]
    assert len(found) == len(set(found)) and set(found) <= want and len(found) >= (1 if bits is None else 0.95) * len(want)
    assert max(abs(r.distance - d[r.a, r.b]) for r in got) < 1e-9
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1])], "vec_id long, embedding array<double>")
    assert [(r.a, r.b) for r in neighbors.lsh_pairs(twice, 0.5, bits=bits).collect()] == [(1, 2), (1, 2)]


def test_pairs_are_made_once_for_the_top(spark):
    """the nearest were taken from a union of both directions, which made all pairs twice."""
    from plumbline.plans import vectors

    plan = vectors.ann_topk(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1


def test_fold_sends_pairs_no_more_than_it_must(spark):
    """rows that have become members left their pairs open to others, and pairs were dealt out to be distinct."""
    n = 150
    ids = spark.createDataFrame([(i,) for i in range(n)], "vec_id long")
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n) if (i + j) % 2 or j - i < 9]
    df = spark.createDataFrame(pairs * 2, "a long, b long").coalesce(1).localCheckpoint()
    assert shuffled(spark, lambda: neighbors.fold(ids, df).collect()) < 5 * len(pairs)


def test_tables_by_distance():
    for near, bits in ((0.6, 4), (0.6, 6), (0.2, 10)):
        same, n = 1 - np.arccos(1 - near) / np.pi, neighbors.lsh_tables(near, bits, 0.95)
        assert 1 - (1 - same**bits) ** n >= 0.95 > 1 - (1 - same**bits) ** (n - 1)


def test_older_embedding_is_that_of_the_beginning(spark, tmp_path):
    from plumbline.plans import vectors
    from plumbline.sources.embedder import hashing

    texts = ["short", None, "some words that make more than thirty characters", "word " * 3000 + "tail end"]
    spark.createDataFrame([(i, t, "src") for i, t in enumerate(texts)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.embedding for r in vectors.embed_documents(spark, str(tmp_path)).collect()}
    assert set(got) == {2, 3}
    for i, v in got.items():
        assert np.allclose(v, hashing([("src. " + texts[i])[:2000]], 768)[0], atol=1e-6)


def test_registered_embedding_is_that_of_whole_texts(spark, tmp_path):
    from plumbline.plans import vectors
    from plumbline.sources.embedder import hashing

    texts = ["a b c", None, "word " * 3000 + "tail end"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.embedding for r in vectors.embed_text(spark, str(tmp_path)).collect()}
    assert all(np.allclose(got[i], hashing([t or ""], 256)[0], atol=1e-6) for i, t in enumerate(texts))


def test_truncated_vectors_have_length_one(spark):
    df = spark.createDataFrame([([float(i + 1) for i in range(1024)],), ([0.0] * 300,)], "v array<float>")
    a, b = (np.array(r.t) for r in df.select(V.truncate(F.col("v")).alias("t")).collect())
    assert len(a) == 256 and abs(np.linalg.norm(a) - 1) < 1e-5 and not b.any()


def test_two_blobs_come_apart(spark):
    rng = np.random.default_rng(0)
    blobs = np.vstack([rng.normal(0, 0.01, (40, 8)) + np.eye(8)[0], rng.normal(0, 0.01, (40, 8)) + np.eye(8)[1]])
    df = spark.createDataFrame([(i + 1, v.tolist()) for i, v in enumerate(blobs)], "vec_id long, embedding array<float>")
    for k in (2, 4):
        label = dict(map(tuple, cluster.relabel(cluster.fine(cluster.coarse(df, k=k, dims=8))).collect()))
        one, two = {label.get(i) for i in range(1, 41)} - {None}, {label.get(i) for i in range(41, 81)} - {None}
        assert one and two and not one & two
    assert {int(x) for x in cluster._density(blobs, 5)} - {-1} == {0, 1}


def test_large_bucket_is_clustered_as_a_whole(spark, monkeypatch):
    rng = np.random.default_rng(0)
    blobs = np.vstack([rng.normal(0, 0.01, (n, 4)) + np.eye(4)[i] for i, n in enumerate((2200, 2200, 8))])
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(blobs)], "id long, v array<double>, bucket int")
    label = dict(map(tuple, cluster.relabel(cluster.fine(df)).collect()))
    parts = [{label.get(i) for i in range(*r)} - {None} for r in ((0, 2200), (2200, 4400), (4400, 4408))]
    assert [len(p) for p in parts] == [1, 1, 1] and len(set.union(*parts)) == 3
    few = rng.normal(0, 1, (300, 4))
    want = cluster._density(few, 5)
    monkeypatch.setattr(cluster, "BLOCK", 20)
    assert (cluster._density(few, 5) == want).all()


def test_buckets_of_the_registered_query_follow_the_rows(spark, monkeypatch):
    from plumbline.plans import vectors

    seen = []
    whole = cluster.fine
    monkeypatch.setattr(cluster, "fine", lambda b: whole(seen.append(b) or b))
    assert vectors.density_clusters(spark, "/root/testdata/sf0.001").count() > 0
    assert seen[0].select("bucket").distinct().count() > 4


def test_rollups(spark):
    m = spark.createDataFrame([(1, 10, "a", 2, 5, "2023-02-01"), (1, 11, "b", 1, None, "2023-05-01"), (1, 12, "a", 1, 10, "2024-06-01"), (2, 20, "a", 1, 0, None)], "cluster_id long, id long, source string, dup_count long, score long, at string").withColumn("created_at_src", F.to_timestamp("at")).withColumn("is_duplicate", F.lit(False))
    got = {r.cluster_id: r for r in rollup.materialise(m, "2024-12-01").collect()}
    assert (got[1].member_count, got[1].total_dup_weight, got[1].source_spread, got[1].sources, got[1].medoid_signal_id) == (3, 4, 2, ["a", "b"], 10)
    assert got[2].trend_acceleration is None and got[2].yoy_ratio is None and got[1].yoy_ratio == 0.5
    assert rollup.yoy_ratio(m, "2024-01-15").filter("cluster_id = 1").first().yoy_ratio is None


def test_scores_and_records(spark):
    reply = 'ok {"wedge_score":4,"wave_score":3,"edge_score":2,"saturation_ok":%s,"competitors":{"name":"A","funded":true}}'
    df = spark.createDataFrame([(1, "s" * 300, "ecom", reply % "true"), (2, "t", "ecom", reply % "false"), (3, "t", "ecom", "no json")], "id long, statement string, icp string, reply string")
    got = {r.problem_statement_id: r for r in statements.opportunities(df).collect()}
    assert set(got) == {1, 2} and got[1].final_score == pytest.approx(3.3) and got[2].final_score == 0
    assert len(got[1].title) == 200 and got[1].n_funded_incumbents == 1 and got[1].expansion_vector == "unknown_wedge"
    assert rows(statements.competitors(statements.opportunities(df))) == [(1, "A", False, ""), (2, "A", False, "")]


def test_ask_goes_through_the_client(spark):
    df = spark.createDataFrame([(1, "q")], "id long, text string")
    out = statements.ask(df, F.col("text"), lambda prompts: [p.upper() for p in prompts])
    assert out.first().reply == "Q"
    many = spark.createDataFrame([(i, f"t{i}", i % 3, 1) for i in range(5)], "id long, text string, score long, dup_count long")
    got = [(r.batch, r["items"]) for r in statements.batches(many, 2).orderBy("batch").collect()]
    assert got == [(0, '[{"id":2,"text":"t2"},{"id":1,"text":"t1"}]'), (1, '[{"id":4,"text":"t4"},{"id":0,"text":"t0"}]'), (2, '[{"id":3,"text":"t3"}]')]


def test_retries():
    from plumbline.operators import queues

    calls, waits = [], []

    def fails(n):
        def call():
            calls.append(1)
            if len(calls) <= n:
                raise OSError("busy")
            return "ok"

        return call

    assert queues.retried(fails(2), 3, queues.exponential, waits.append) == "ok" and waits == [1.0, 2.0]
    calls.clear()
    with pytest.raises(OSError):
        queues.retried(fails(9), 3, sleep=waits.append)
    assert len(calls) == 3 and waits[2:] == [2.0, 4.0]
