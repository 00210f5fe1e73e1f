"""Coarse-to-fine clustering: k-means buckets, density clusters inside each, dense labels."""

from __future__ import annotations

import math
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.vectors import truncate
from plumbline.operators import spantree
from plumbline.session import cut

#: Distances that a task holds at once: those of so many vectors to so many.
BLOCK = 4000


def default_k(n: int) -> int:
    """About the root of half the rows, plus one; between 2 and n."""
    return max(2, min(n, int(math.sqrt(n / 2)) + 1))


def coarse(vectors: DataFrame, k: int | None = None, dims: int = 256, seed: int = 42, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, v, bucket): k-means on truncated vectors."""
    rows = vectors.select(F.col(id_col).alias("id"), truncate(F.col(vec_col), dims).alias("v")).filter("v is not null")
    n = rows.count()
    if n < 2:
        return rows.withColumn("bucket", F.lit(0))
    data = rows.withColumn("features", array_to_vector("v"))
    model = KMeans(k=min(k or default_k(n), n), seed=seed, featuresCol="features", predictionCol="bucket").fit(data)
    return model.transform(data).drop("features")


def _density(x: np.ndarray, least: int) -> np.ndarray:
    """Labels by mutual reachability of one bucket; -1 is noise. Distances are made as they are needed, so only time goes by the square."""
    n = len(x)
    x = np.asarray(x, np.float64)
    step = max(1, BLOCK * BLOCK // n)
    place = min(least, n - 1)
    core = np.concatenate([np.partition(spantree.distances(x[i : i + step], x), place, axis=1)[:, place] for i in range(0, n, step)])
    inside, near, link = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, int)  # a spanning tree, by Prim
    at, edges = 0, []
    for _ in range(n - 1):
        inside[at] = True
        reach = np.maximum(np.maximum(spantree.distances(x[at : at + 1], x)[0], core[at]), core)
        closer = ~inside & (reach < near)
        near[closer], link[closer] = reach[closer], at
        at = int(np.argmin(np.where(inside, np.inf, near)))
        edges.append((near[at], int(link[at]), at))
    return hierarchy(n, edges, least)


def hierarchy(n: int, edges: list[tuple[float, int, int]], least: int) -> np.ndarray:
    """Labels from a spanning tree's edges (length, a, b): the tree cut into a hierarchy, of which the stablest clusters stay; -1 is noise.

    Parts that one length joins are joined at once, so labels don't depend on which of several shortest trees it is.
    Where no split is stable the whole is one cluster, so that an even bucket isn't lost as noise.
    """
    top = list(range(n))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    size, name = [1] * n, list(range(n))
    kids: dict[int, tuple[list[int], float]] = {}
    for height, group in groupby(sorted(edges), lambda e: e[0]):
        ends = [(find(a), find(b)) for _, a, b in group]
        for a, b in ends:
            top[find(b)] = find(a)
        parts: dict[int, list[int]] = {}
        for r in dict.fromkeys(r for e in ends for r in e):
            parts.setdefault(find(r), []).append(name[r])
        for r, held in parts.items():
            name[r] = len(size)
            kids[len(size)] = (held, height)
            size.append(sum(size[k] for k in held))

    def leaves(node: int) -> list[int]:
        out, stack = [], [node]
        while stack:
            i = stack.pop()
            if i < n:
                out.append(i)
            else:
                stack += kids[i][0]
        return out

    # Downwards: a split into parts of ``least`` or more makes a cluster of each; else points fall out.
    clusters: list[dict] = [{"node": len(size) - 1, "birth": 0.0, "gain": 0.0, "kids": []}]
    todo = [0]
    while todo:
        c = todo.pop()
        own, node = clusters[c], clusters[c]["node"]
        while node >= n:
            held, height = kids[node]
            level = 1 / max(height, 1e-12)
            large = [k for k in held if size[k] >= least]
            lost = size[node] if len(large) > 1 else size[node] - sum(size[k] for k in large)
            own["gain"] += (level - own["birth"]) * lost
            if len(large) != 1:
                for k in large:
                    own["kids"].append(len(clusters))
                    todo.append(len(clusters))
                    clusters.append({"node": k, "birth": level, "gain": 0.0, "kids": []})
                break
            node = large[0]
    best = [0.0] * len(clusters)
    for c in range(len(clusters) - 1, -1, -1):
        below = sum(best[k] for k in clusters[c]["kids"])
        clusters[c]["stays"] = c != 0 and clusters[c]["gain"] >= below
        best[c] = max(clusters[c]["gain"], below) if c else below
    found, stack = [], [0]
    while stack:
        c = stack.pop()
        if clusters[c]["stays"]:
            found.append(leaves(clusters[c]["node"]))
        else:
            stack += clusters[c]["kids"]
    if not found:
        return np.zeros(n, int)
    labels = np.full(n, -1)
    for label, members in enumerate(sorted(found, key=min)):
        labels[members] = label
    return labels


def fine(bucketed: DataFrame, least: int = 5, whole: int = BLOCK, block: int = spantree.BLOCK) -> DataFrame:
    """(id, bucket, local): density clusters inside each bucket; a small bucket is one cluster, noise is -1.

    A bucket of at most ``whole`` vectors is solved in one task. The spanning tree of a larger one is found over all
    executors (``spantree``), with the same result; one task then gets its edges, 24 bytes a vector.
    """
    rows = bucketed.select("id", "v", "bucket")
    large = bucketed.groupBy("bucket").agg(F.count("*").alias("_n")).filter(F.col("_n") > max(whole, 2 * least, 6))
    large = cut(large.select("bucket"))
    alone = max(2 * least, 6)

    def solve(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("id").to_numpy())
        x = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(order), -1)[order]
        ids = t.column("id").to_numpy()[order]
        local = np.zeros(len(ids), int) if len(ids) < alone else _density(x, least)
        return pa.table({"id": ids, "bucket": pa.array(t.column("bucket").to_numpy()[order].astype(np.int32)), "local": pa.array(local.astype(np.int32))})

    def cut_up(t: pa.Table) -> pa.Table:
        w, lo, hi = (t.column(c).to_numpy() for c in ("w", "lo", "hi"))
        ids, place = np.unique(np.concatenate((lo, hi)), return_inverse=True)
        local = hierarchy(len(ids), list(zip(w.tolist(), place[: len(w)].tolist(), place[len(w) :].tolist(), strict=True)), least)
        return pa.table({"id": ids, "bucket": pa.array([t.column("bucket")[0].as_py()] * len(ids), pa.int32()), "local": pa.array(local.astype(np.int32))})

    kind = "id long, bucket int, local int"
    if large.isEmpty():
        return rows.groupBy("bucket").applyInArrow(solve, kind)
    trees = spantree.spanning_trees(rows.join(large, "bucket", "left_semi"), least, block=block)
    done = trees.groupBy("bucket").applyInArrow(cut_up, kind)
    return rows.join(large, "bucket", "left_anti").groupBy("bucket").applyInArrow(solve, kind).unionByName(done)


def relabel(found: DataFrame) -> DataFrame:
    """(id, cluster_id): dense labels by (bucket, first id of the cluster); noise is left out.

    The window runs over clusters, not rows.
    """
    rows = found.filter("local >= 0")
    names = rows.groupBy("bucket", "local").agg(F.min("id").alias("first"))
    names = names.withColumn("cluster_id", (F.row_number().over(Window.orderBy("bucket", "first")) - 1).cast("bigint"))
    return rows.join(names, ["bucket", "local"]).select("id", "cluster_id")


def reassign(signals: DataFrame, assigned: DataFrame, scope=None) -> DataFrame:
    """Signals with new cluster ids: reset in scope, then set where assigned."""
    inside = F.lit(True) if scope is None else scope
    new = assigned.select(F.col("id").alias("_id"), F.col("cluster_id").alias("_new"))
    out = signals.join(new, signals["id"] == F.col("_id"), "left")
    return out.withColumn("cluster_id", F.when(F.col("_new").isNotNull(), F.col("_new")).when(~inside, F.col("cluster_id"))).drop("_id", "_new")
