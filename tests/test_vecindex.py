"""The kept vector index against exact search: recall, appended rows, ranges, and the fold after each batch."""

import numpy as np
import pytest

import __spark_entry__ as entry_points
from plumbline.operators import neighbors, vecindex
from plumbline.plans.vectors import NEAR

DIR = "/root/testdata/sf0.1"


def groups(n, dims, seed, spread=0.2, centres=12):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((centres, dims))
    return (base[rng.integers(0, centres, n)] + spread * rng.standard_normal((n, dims))).astype(np.float32)


def frame(spark, x, first=0):
    return spark.createDataFrame([(first + i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")


def test_recall_of_the_registered_query(spark):
    """Top 200 under the distance of every vector, with rows appended after the build."""
    e = spark.read.parquet(f"{DIR}/embeddings.parquet")
    want = neighbors.neighbours(neighbors.exact_pairs(e, NEAR), 200).select("seed", "neighbour").toPandas()
    got = entry_points.queries()["index_topk"](spark, DIR).toPandas()
    pairs = set(zip(want.seed, want.neighbour, strict=True))
    found = set(zip(got["query"], got.neighbour, strict=True))
    assert len(pairs & found) >= 0.95 * len(pairs) and pairs
    assert (got.distance < NEAR).all() and got.groupby("query")["rank"].apply(lambda r: sorted(r) == list(range(1, len(r) + 1))).all()


def test_appended_rows_are_found_by_a_later_session(spark, tmp_path):
    x, more = groups(1200, 24, 1), groups(300, 24, 1, centres=12)
    path = f"file://{tmp_path}/index"
    vecindex.VectorIndex.build(frame(spark, x), path, k=10)
    vecindex.VectorIndex(spark, path).append(frame(spark, more, 5000))
    index = vecindex.VectorIndex(spark, path)
    every = frame(spark, x).unionByName(frame(spark, more, 5000))
    assert index.rows().count() == 1500 and index.model.probes < len(index.model.centres)
    got = {(r["query"], r.neighbour) for r in index.search(every, 10).collect()}
    want = {(r["query"], r.neighbour) for r in neighbors.knn(every, every, 10).collect()}
    assert len(got & want) >= 0.95 * len(want)
    assert {q for q, _ in got} == {r.vec_id for r in every.collect()} and any(q < 5000 <= n for q, n in got)
    plan = index.rows([3])._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in plan and "= 3)" in plan  # a filter of files, not of rows


def test_codes_shortlist_when_cells_are_large(spark, tmp_path, monkeypatch):
    """One cell of many rows: what the codes rank first holds the nearest."""
    x = groups(1500, 16, 4, 0.4, 40)
    index = vecindex.VectorIndex.build(frame(spark, x), f"file://{tmp_path}/index", k=5, cells=2)
    e = frame(spark, x)
    got = {(r["query"], r.neighbour) for r in index.search(e, 5).collect()}
    want = {(r["query"], r.neighbour) for r in neighbors.knn(e, e, 5).collect()}
    assert len(got & want) >= 0.95 * len(want)
    model, unit = index.model, x / np.linalg.norm(x, axis=1, keepdims=True)
    own = model.cells(unit) == 0
    away = model.asymmetric(unit[:20], 0, model.codes(unit[own], np.zeros(own.sum(), int)))
    assert np.corrcoef(away.ravel(), vecindex._squared(unit[:20], unit[own]).ravel())[0, 1] > 0.97


@pytest.mark.parametrize("near", [0.01, 0.1, 0.5])
def test_ranges_are_exact_and_leave_cells_out(spark, tmp_path, near):
    x = groups(800, 12, 2)
    index = vecindex.VectorIndex.build(frame(spark, x), f"file://{tmp_path}/index", k=10)
    q = frame(spark, groups(100, 12, 2, 0.25), 10_000)
    unit = lambda a: a / np.linalg.norm(a.astype(np.float64), axis=1, keepdims=True)
    d = 1 - unit(groups(100, 12, 2, 0.25)) @ unit(x).T
    got = {(r["query"] - 10_000, r.neighbour) for r in index.within(q, near).collect()}
    assert got == set(zip(*(a.tolist() for a in np.nonzero(d < near)), strict=True))
    visits = index._visits(q, "vec_id", "embedding", near, None).count()
    assert near > 0.1 or visits < 0.8 * 100 * len(index.model.centres)


def test_odd_vectors_are_left_out(spark, tmp_path):
    nan = float("nan")
    rows = [(i, [float(i % 5 + 1), 1.0]) for i in range(20)] + [(None, [1.0, 1.0]), (30, None), (31, [nan, 1.0]), (32, [None, 1.0]), (33, [1.0]), (34, [0.0, 0.0]), (35, []), (3, [4.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = vecindex.VectorIndex.build(df, f"file://{tmp_path}/index", k=3, parts=3)
    assert sorted(r.id for r in index.rows().collect()) == sorted([*range(20), 3])
    assert {r["query"] for r in index.search(df, 3).collect()} == set(range(20))
    assert index.within(df.limit(0), 0.1).count() == 0 and index.search(df.limit(0), 3).count() == 0
    with pytest.raises(ValueError):
        vecindex.VectorIndex.build(df.limit(0), f"file://{tmp_path}/none")


def test_fold_after_each_batch_equals_the_fold_of_all(spark, tmp_path):
    near, x = 0.05, groups(600, 8, 3, 0.12, 30)
    every = frame(spark, x)
    path = f"file://{tmp_path}/fold"
    for low, high in ((0, 100), (100, 101), (101, 400), (400, 600)):
        state = vecindex.OnlineFold(spark, path, near)  # as a later session would
        state.add(every.filter(f"vec_id >= {low} and vec_id < {high}"))
        so_far = every.filter(f"vec_id < {high}")
        want = {(r.id, r.seed) for r in neighbors.fold(so_far, neighbors.exact_pairs(so_far, near)).collect()}
        assert {(r.id, r.seed) for r in state.folded().collect()} == want
    assert 1 < len({s for _, s in want}) < 600
    with pytest.raises(ValueError):
        vecindex.OnlineFold(spark, path, near).add(every.filter("vec_id = 5"))
    state.add(every.limit(0))


def test_a_query_is_sent_once_for_each_bundle_of_cells(spark, tmp_path):
    """What is sent follows bundles of so many vectors, not probed cells; a task's batch of visits is bounded."""
    x = groups(1500, 24, 7)
    index = vecindex.VectorIndex.build(frame(spark, x), f"file://{tmp_path}/index", k=10, cells=40)
    bundle = index._bundles()
    assert bundle.max() == 0  # 1500 vectors meet in one block
    visits = index._visits(frame(spark, x), "vec_id", "embedding", None, 30, bundle)
    assert visits.count() == 1500 and visits.selectExpr("sum(size(cells))").first()[0] == 1500 * 30


def test_what_is_sent_does_not_grow_with_the_square_of_the_rows(spark, tmp_path, monkeypatch):
    """However small the blocks of a small table are, a vector goes to so many tasks; what is found stays the same."""
    monkeypatch.setattr(vecindex, "QUERIES", 20)
    monkeypatch.setattr(vecindex, "VECTORS", 40)
    x = groups(3000, 16, 9)
    e = frame(spark, x)
    index = vecindex.VectorIndex.build(e, f"file://{tmp_path}/index", k=10)
    store = spark.sparkContext._jsc.sc().statusStore
    stages = lambda: store().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    done = {stages().apply(i).stageId() for i in range(stages().size())}
    unit = x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    d = 1 - unit @ unit.T
    np.fill_diagonal(d, 2)
    near = float(np.partition(d.ravel(), 3000)[3000])
    got = {(r["query"], r.neighbour) for r in index.search(e, 3000, near, len(index.model.centres)).collect()}
    assert got == set(zip(*(a.tolist() for a in np.nonzero(d < near)), strict=True)) and got
    every = stages()
    sent = sum(every.apply(i).shuffleWriteRecords() for i in range(every.size()) if every.apply(i).stageId() not in done)
    assert sent < 3000 * 2 * (neighbors.BLOCKS + 2)


def test_single_and_double_floats_are_stored_as_given(spark, tmp_path):
    """An index of single floats takes doubles as well, and ranges are those of the doubles."""
    x = groups(300, 12, 5)
    more = groups(100, 12, 6).astype(np.float64) + 1e-9
    doubles = spark.createDataFrame([(1000 + i, v.tolist()) for i, v in enumerate(more)], "vec_id long, embedding array<double>")
    index = vecindex.VectorIndex.build(frame(spark, x), f"file://{tmp_path}/index", k=10)
    index.append(doubles)
    assert {(r.id >= 1000, len(r.v)) for r in index.rows().collect()} == {(False, 48), (True, 96)}
    unit = np.vstack([x.astype(np.float64), more])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids = [*range(300), *range(1000, 1100)]
    d = 1 - unit[300:] @ unit.T
    got = {(r["query"], r.neighbour): r.distance for r in index.within(doubles, 0.2).collect()}
    assert set(got) == {(ids[300 + i], ids[j]) for i, j in zip(*np.nonzero(d < 0.2), strict=True)}
    assert all(abs(got[ids[300 + i], ids[j]] - d[i, j]) < 1e-12 for i, j in zip(*np.nonzero(d < 0.2), strict=True))
