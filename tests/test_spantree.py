"""Density clusters over distributed trees against one bucket in one task, and that against a naive hierarchy."""

import numpy as np
import pytest

from plumbline.operators import cluster, spantree


def blobs(seed, sizes=(60, 45, 30), noise=25, dims=3, grid=None):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(rng.uniform(-8, 8, dims), rng.uniform(0.2, 0.9), (n, dims)) for n in sizes]
    x = np.concatenate([*parts, rng.uniform(-10, 10, (noise, dims))])
    x = x if grid is None else np.round(x / grid) * grid  # many ties and repeated vectors
    return x[rng.permutation(len(x))]


def naive(x, least):
    """Clusters by thresholds: at each height the components of what is nearer; nothing is shared with the library."""
    n = len(x)
    d = np.sqrt(np.round(((x[:, None] - x[None]) ** 2).sum(2), 10))
    core = np.sort(d, axis=1)[:, min(least, n - 1)]
    m = np.maximum(np.maximum(d, core[:, None]), core[None])
    heights = sorted(set(m[np.triu_indices(n, 1)].tolist()), reverse=True)

    def parts(of, below):
        left, out = set(of), []
        while left:
            todo = [left.pop()]
            one = list(todo)
            while todo:
                at = todo.pop()
                new = [j for j in left if m[at, j] < below]
                left -= set(new)
                todo += new
                one += new
            out.append(one)
        return out

    def walk(of, birth):
        """(stability, clusters chosen) of a part that is born at a level."""
        gain, at = 0.0, list(of)
        for h in [h for h in heights]:
            split = parts(at, h)
            if len(split) == 1:
                continue
            level, large = 1 / max(h, 1e-12), [p for p in split if len(p) >= least]
            if len(large) == 1:
                gain += (level - birth) * (len(at) - len(large[0]))
                at = large[0]
                continue
            gain += (level - birth) * len(at)
            below = [walk(p, level) for p in large]
            total = sum(g for g, _ in below)
            return (gain, [list(of)]) if gain >= total else (total, [c for _, f in below for c in f])
        return gain, [list(of)]

    below, at = [], list(range(n))
    for h in heights:
        split = parts(at, h)
        large = [p for p in split if len(p) >= least]
        if len(split) > 1 and len(large) == 1:
            at = large[0]
        elif len(split) > 1:
            below = [c for p in large for c in walk(p, 1 / max(h, 1e-12))[1]]
            break
    labels = np.full(n, -1) if below else np.zeros(n, int)
    for k, c in enumerate(sorted(below, key=min)):
        labels[c] = k
    return labels


@pytest.mark.parametrize("x", [blobs(1, (30, 25), 10), blobs(2, (20, 20, 15), 6, 2), blobs(3, (25, 20), 8, 2, 0.5), np.zeros((12, 2)), np.arange(24.0)[:, None]], ids=["blobs", "three", "ties", "same", "even"])
def test_one_bucket_against_a_naive_hierarchy(x):
    assert cluster._density(x, 5).tolist() == naive(x, 5).tolist()


@pytest.mark.parametrize("x, block, listed", [(blobs(4), 40, 6), (blobs(5, grid=0.4), 64, 16), (blobs(6, (150,), 0, 8), 1000, 5)], ids=["blobs", "ties", "one"])
def test_distributed_tree_gives_the_same_labels(spark, monkeypatch, x, block, listed):
    """Two large buckets and a small one at once; ids in another order than rows."""
    monkeypatch.setattr(spantree.spanning_trees, "__defaults__", (listed, block))
    rng = np.random.default_rng(0)
    ids = rng.permutation(3 * len(x))[: len(x)]
    rows = [(int(i), v.tolist(), 7) for i, v in zip(ids, x, strict=True)] + [(int(i) + 10_000, (v * 3).tolist(), 8) for i, v in zip(ids, x[: len(x) // 2], strict=False)]
    rows += [(20_000 + i, [float(i)] * x.shape[1], 9) for i in range(4)]
    df = spark.createDataFrame(rows, "id long, v array<double>, bucket int").repartition(4)
    got = {r.id: (r.bucket, r.local) for r in cluster.fine(df, 5, whole=20, block=block).collect()}
    want = {}
    for b in (7, 8, 9):
        own = sorted((i, v) for i, v, k in rows if k == b)
        local = cluster._density(np.array([v for _, v in own]), 5) if b < 9 else [0] * len(own)
        want |= {i: (b, int(k)) for (i, _), k in zip(own, local, strict=True)}
    assert got == want


def test_tree_is_the_shortest(spark):
    x = blobs(9, (40, 30), 10)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "id long, v array<double>, bucket int")
    edges = spantree.spanning_trees(df, 5, 8, 30).collect()
    d = spantree.distances(x, x)
    core = np.sort(d, axis=1)[:, 5]
    m = np.maximum(np.maximum(d, core[:, None]), core[None])
    inside, total = {0}, 0.0
    while len(inside) < len(x):
        rest = [j for j in range(len(x)) if j not in inside]
        part = m[np.ix_(sorted(inside), rest)]
        total += part.min()
        inside.add(rest[part.min(0).argmin()])
    assert len(edges) == len(x) - 1 and np.isclose(sum(e.w for e in edges), total)
    assert spantree.spanning_trees(df.limit(0), 5).count() == 0
