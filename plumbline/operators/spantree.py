"""Minimum spanning trees of mutual reachability, in Boruvka rounds of DataFrame joins.

Inside a bucket two vectors are apart by their distance, or by the core distance of either (that
to its ``least``-th neighbour) if it is larger. Every round each component takes its shortest
edge to another one. Edges come from lists of each vector's nearest neighbours as long as a
component's best one is certain: nothing outside a vector's list is nearer than the list's end.
Where no component is certain any more, one round looks at all pairs, in blocks, so no task
has more than two blocks of vectors. Edges are ordered by length, then by ids, so rounds never
close a circle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import kept

#: Vectors of a block, and neighbours that are listed.
BLOCK, LISTED = 2000, 16


def cut(df: DataFrame) -> DataFrame:
    """Go on from Parquet: a checkpoint keeps what the plan before it implied of its columns, which grows manifold with each round's joins."""
    return kept(df, "tree")


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances, rounded so that they don't depend on how pairs were dealt."""
    square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T
    return np.sqrt(np.maximum(np.round(square, 10), 0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _met(rows: DataFrame, sizes: DataFrame, block: int):
    """Each two blocks of a bucket in one group."""
    n = F.ceil(F.col("n") / block).cast("int")
    dealt = rows.join(sizes, "bucket").withColumn("blocks", n).withColumn("b", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("b", o).alias("x"), F.greatest("b", o).alias("y"))))
    return dealt.withColumn("p", pair).select(*rows.columns, "b", "p.x", "p.y").groupBy("bucket", "x", "y")


def _sides(t: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places of one block against those of the other, both ways round."""
    x, y, b = t.column("x")[0].as_py(), t.column("y")[0].as_py(), t.column("b").to_numpy()
    one, two = np.flatnonzero(b == x), np.flatnonzero(b == y)
    return [(one, two)] if x == y else [(one, two), (two, one)]


def neighbour_lists(rows: DataFrame, sizes: DataFrame, listed: int = LISTED, block: int = BLOCK) -> DataFrame:
    """(bucket, id, near): each vector's nearest others in its bucket, (d, id) in order."""

    def nearest(t: pa.Table) -> pa.Table:
        ids, v, bucket = t.column("id").to_numpy(), _matrix(t.column("v")), t.column("bucket")[0].as_py()
        own, near = [], []
        for one, two in _sides(t):
            d = distances(v[one], v[two])
            d[ids[one][:, None] == ids[two][None]] = np.inf
            k = min(listed, len(two))
            for i, row in zip(one, d, strict=True):
                at = np.argpartition(row, k - 1)[:k] if k else np.zeros(0, int)
                ties = np.flatnonzero(row <= row[at].max()) if k else at
                order = ties[np.lexsort((ids[two][ties], row[ties]))][:k]
                own.append(ids[i])
                near.append([{"d": row[j], "id": ids[two][j]} for j in order if np.isfinite(row[j])])
        return pa.table({"bucket": pa.array([bucket] * len(own), pa.int32()), "id": pa.array(own, pa.int64()), "near": pa.array(near, pa.list_(pa.struct([("d", pa.float64()), ("id", pa.int64())])))})

    found = _met(rows.select("bucket", "id", "v"), sizes, block).applyInArrow(nearest, "bucket int, id long, near array<struct<d:double,id:long>>")
    return found.groupBy("bucket", "id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, listed).alias("near"))


_EDGE = "bucket int, part long, edge struct<w:double,lo:long,hi:long,other:long>"


def _scanned(nodes: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Each component's shortest edge to another, from all pairs."""

    def shortest(t: pa.Table) -> pa.Table:
        ids, v, part, core = t.column("id").to_numpy(), _matrix(t.column("v")), t.column("part").to_numpy(), t.column("core").to_numpy()
        best: dict[int, tuple] = {}
        for one, two in _sides(t):
            w = np.maximum(np.maximum(distances(v[one], v[two]), core[one][:, None]), core[two][None])
            w[part[one][:, None] == part[two][None]] = np.inf
            low = w.min(1) if len(two) else np.full(len(one), np.inf)
            for i in np.flatnonzero(np.isfinite(low)):
                a = ids[one[i]]
                for j in two[np.flatnonzero(w[i] == low[i])]:
                    edge = (low[i], min(a, ids[j]), max(a, ids[j]), part[j])
                    if part[one[i]] not in best or edge < best[part[one[i]]]:
                        best[part[one[i]]] = edge
        kind = pa.struct([("w", pa.float64()), ("lo", pa.int64()), ("hi", pa.int64()), ("other", pa.int64())])
        edges = [dict(zip(("w", "lo", "hi", "other"), e, strict=True)) for e in best.values()]
        return pa.table({"bucket": pa.array([t.column("bucket")[0].as_py()] * len(best), pa.int32()), "part": pa.array(list(best), pa.int64()), "edge": pa.array(edges, kind)})

    return _met(nodes.select("bucket", "id", "v", "part", "core"), sizes, block).applyInArrow(shortest, _EDGE).groupBy("bucket", "part").agg(F.min("edge").alias("edge"))


def _certain(nodes: DataFrame) -> DataFrame:
    """Each component's shortest edge to another, where the lists are sure to hold it."""
    far = nodes.select("bucket", F.col("id").alias("o"), F.col("core").alias("core_o"), F.col("part").alias("other"))
    listed = nodes.select("bucket", "id", "part", "core", F.explode("near").alias("x")).select("bucket", "id", "part", "core", F.col("x.d").alias("d"), F.col("x.id").alias("o")).join(far, ["bucket", "o"])
    edge = F.struct(F.greatest("d", "core", "core_o").alias("w"), F.least("id", "o").alias("lo"), F.greatest("id", "o").alias("hi"), "other")
    best = listed.filter("part <> other").groupBy("bucket", "part").agg(F.min(edge).alias("edge"))
    bound = nodes.groupBy("bucket", "part").agg(F.min("reach").alias("reach"))
    return best.join(bound, ["bucket", "part"]).filter(F.col("edge.w") < F.col("reach")).select("bucket", "part", "edge")


def _joined(picked: DataFrame) -> DataFrame:
    """(bucket, part, root): where each component that has picked an edge ends up."""
    to = picked.select("bucket", "part", F.col("edge.other").alias("root"))
    back = to.select("bucket", F.col("part").alias("root"), F.col("root").alias("back"))
    now = cut(to.join(back, ["bucket", "root"], "left").select("bucket", "part", F.when((F.col("back") == F.col("part")) & (F.col("part") < F.col("root")), F.col("part")).otherwise(F.col("root")).alias("root")))
    while True:
        step = now.select("bucket", F.col("part").alias("root"), F.col("root").alias("next"))
        further = cut(now.join(step, ["bucket", "root"], "left").select("bucket", "part", F.coalesce("next", "root").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
        now = further.drop("moved")
        if further.filter("moved").isEmpty():
            return now


def spanning_trees(rows: DataFrame, least: int, listed: int = LISTED, block: int = BLOCK) -> DataFrame:
    """(bucket, w, lo, hi): the edges of each bucket's tree. ``rows``: (bucket, id, v), an id once."""
    rows = cut(rows.select(F.col("bucket").cast("int").alias("bucket"), F.col("id").cast("long").alias("id"), "v"))
    sizes = cut(rows.groupBy("bucket").agg(F.count("*").alias("n")))
    near = neighbour_lists(rows, sizes, max(listed, least), block).join(sizes, "bucket")
    core = F.coalesce(F.get("near", F.least(F.lit(least), F.size("near")) - 1)["d"], F.lit(0.0))
    whole = F.size("near") == F.col("n") - 1
    near = near.select("bucket", "id", "near", core.alias("core"), F.when(whole, F.lit(float("inf"))).otherwise(F.greatest(F.get("near", F.size("near") - 1)["d"], core)).alias("reach"))
    nodes = cut(rows.join(near, ["bucket", "id"]).withColumn("part", F.col("id")))
    edges, trees, sure = None, sizes.count(), True
    while nodes.select("bucket", "part").distinct().count() > trees:
        picked = cut(_certain(nodes)) if sure else None
        if picked is None or picked.isEmpty():
            sure = False  # components only grow, and their lists' outward edges only get fewer
            picked = cut(_scanned(nodes, sizes, block))
        found = cut(picked.select("bucket", "edge.w", "edge.lo", "edge.hi").distinct())
        edges = found if edges is None else edges.unionByName(found)
        nodes = cut(nodes.join(_joined(picked), ["bucket", "part"], "left").withColumn("part", F.coalesce("root", "part")).drop("root"))
    none = rows.sparkSession.createDataFrame([], "bucket int, w double, lo long, hi long")
    return none if edges is None else edges
