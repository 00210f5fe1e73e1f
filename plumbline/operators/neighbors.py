"""Vector neighbours: exact in blocks, approximate by random projections, and the ordered fold."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import cut, kept

#: Vectors of a block of ``knn``.
BLOCK = 2000
#: Pairs are made of so many blocks of vectors, each sent to as many tasks, unless a block has under LEAST or over BLOCK_BYTES of single floats.
BLOCKS, LEAST, BLOCK_BYTES = 16, 500, 16 << 20
#: Vectors of two blocks whose products are made at once, and bytes of vectors whose pairs are looked at again.
_TILE, _AT_ONCE = (256, 2048), 16 << 20
#: Sending a vector to one more task counts as so many comparisons: by estimate far more than its time, since room for shuffles is scarcer.
COPY = 16_000


def _unit(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = values.reshape(len(flat), -1)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1.0)


def block_rows(count: int, dims: int) -> int:
    """Vectors of a block for a table of ``count``: a task holds two, and a vector is sent to BLOCKS tasks however many there are."""
    most = max(LEAST, BLOCK_BYTES // (4 * max(1, dims)))
    return min(most, max(LEAST, -(-count // BLOCKS)))


def _rows(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).filter("id is not null and v is not null")


def _blocked(vectors: DataFrame, id_col: str, vec_col: str, block: int) -> tuple[DataFrame, int]:
    rows = _rows(vectors, id_col, vec_col)
    n = max(1, -(-rows.count() // block))
    return rows.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")), n


def candidates(near: float, one: np.ndarray, two: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of the rows of two blocks that may be under ``near``, by products of single floats and the error these can have."""
    least = 1 - near - (one.shape[1] + 4) * 2.0**-22
    for i in range(0, len(one), _TILE[0]):
        for j in range(i - i % _TILE[1] if same else 0, len(two), _TILE[1]):
            part = two[j : j + _TILE[1]]
            at = np.flatnonzero(one[i : i + _TILE[0]] @ part.T > least)
            x, y = at // len(part) + i, at % len(part) + j
            yield (x[x < y], y[x < y]) if same else (x, y)


def _products(near: float, first: bool = False):
    """The pairs under ``near`` of the blocks x and y of vectors; with ``first`` only those that no earlier table has ("before").

    What passes goes out tile by tile, so a task holds the two blocks, whatever they have in common.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches)
        x, y = t.column("x")[0].as_py(), t.column("y")[0].as_py()
        b, ids, v = t.column("b").to_numpy(), t.column("id").to_numpy(), _unit(t.column("v"))
        if first:
            before = t.column("before").combine_chunks()
            hs = before.flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1)
        del t
        one, two = np.flatnonzero(b == x), np.flatnonzero(b == y)
        short = v.astype(np.float32)
        step = max(1, _AT_ONCE // (8 * max(1, v.shape[1])))
        for i, j in candidates(near, short[one], short[two], x == y):
            for at in range(0, len(i), step):
                p, q = one[i[at : at + step]], two[j[at : at + step]]
                d = 1.0 - np.einsum("nd,nd->n", v[p], v[q])
                yes = (d < near) & (ids[p] != ids[q])
                if first:
                    yes &= ~(hs[p] == hs[q]).any(axis=1)
                p, q = ids[p[yes]], ids[q[yes]]
                if len(p):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q)), pa.array(d[yes])], names=["a", "b", "distance"])

    return products


def exact_pairs(vectors: DataFrame, near: float, id_col: str = "vec_id", vec_col: str = "embedding", block: int | None = None) -> DataFrame:
    """(a, b, distance) with a < b of all pairs with cosine distance under ``near``.

    Every two blocks of vectors meet in one task as a matrix product, which holds only what passes. The work
    is that of all pairs: for corpora beyond a few million vectors use ``lsh_pairs``.
    """
    if block is None:
        block = block_rows(*_rows(vectors, id_col, vec_col).agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first())
    rows, n = _blocked(vectors, id_col, vec_col, block)
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda o: F.struct(F.least("b", o).alias("x"), F.greatest("b", o).alias("y"))))
    met = rows.withColumn("p", pair).select("id", "v", "b", "p.x", "p.y")
    return met.groupBy("x", "y").applyInArrow(_products(near), "a long, b long, distance double")


def knn(vectors: DataFrame, queries: DataFrame, k: int = 200, near: float | None = None, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(query, neighbour, distance, rank): the k nearest other vectors of each query, ties by id.

    Query blocks meet shards of the vectors; each task keeps k per query, and only those are ranked.
    """
    q, nq = _blocked(queries, id_col, vec_col, block)
    rows, n = _blocked(vectors, id_col, vec_col, 4 * block)
    left = q.select("id", "v", F.lit(0).alias("side"), F.col("b").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("y"))
    right = rows.select("id", "v", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("x"), F.col("b").alias("y"))

    def nearest(t: pa.Table) -> pa.Table:
        side, ids = t.column("side").to_numpy(), t.column("id").to_numpy()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if len(a) and len(b):
            v = _unit(t.column("v"))
            for at in range(0, len(a), 256):
                part = a[at : at + 256]
                d = 1.0 - v[part] @ v[b].T
                d[ids[part][:, None] == ids[b][None, :]] = np.inf
                if near is not None:
                    d[d >= near] = np.inf
                for row, i in zip(d, part, strict=True):
                    order = np.lexsort((ids[b], row))[:k]
                    order = order[np.isfinite(row[order])]
                    out.append((np.full(len(order), ids[i]), ids[b][order], row[order]))
        cols = [np.concatenate(x) if out else np.zeros(0) for x in (zip(*out, strict=True) if out else ((), (), ()))]
        return pa.table({"query": pa.array(cols[0].astype(np.int64)), "neighbour": pa.array(cols[1].astype(np.int64)), "distance": pa.array(cols[2].astype(np.float64))})

    found = left.unionByName(right).groupBy("x", "y").applyInArrow(nearest, "query long, neighbour long, distance double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "neighbour"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def lsh_tables(near: float, bits: int, recall: float) -> int:
    """Tables of ``bits`` hyperplanes that a pair at distance ``near`` needs to meet in one of them with probability ``recall``."""
    same = 1 - math.acos(min(1.0, max(-1.0, 1 - near))) / math.pi
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-(same**bits)))) if same < 1 and bits else 1


def lsh_bits(count: int, near: float, recall: float, block: int) -> int:
    """Hyperplanes of a table for which comparing and sending ``count`` vectors costs least; none where all pairs cost less than any tables."""

    def cost(bits: int) -> float:
        bucket = count / 2**bits
        return lsh_tables(near, bits, recall) * (bucket / 2 + COPY * math.ceil(bucket / block))

    return min(range(25), key=cost) if near < 2 else 0


def lsh_pairs(vectors: DataFrame, near: float, id_col: str = "vec_id", vec_col: str = "embedding", tables: int | None = None, bits: int | None = None, seed: int = 42, recall: float = 0.98, block: int | None = None) -> DataFrame:
    """(a, b, distance) with a < b, each once: pairs under ``near`` that share a bucket of random hyperplanes in some table, verified.

    Candidates come from equal buckets, so cost follows the buckets, not all pairs. Every table gets every vector, and at wide
    distances there must be many: where neither ``bits`` nor ``tables`` is given, they are those of least cost for the number
    of rows, and without any (one bucket, which finds all pairs) where that is least. Given ``bits`` alone, there are so many
    tables that ``recall`` of the pairs at ``near`` are expected, and more of the nearer ones. Buckets of more than ``block``
    vectors are met in blocks. A pair counts in the first table in which it meets, so what is found needs no second shuffle.

    Null ids and vectors are left out, and vectors with another number of values than the longest. A vector of zeros
    has distance one to all. Rows that repeat an id are neighbours of others, not of each other.
    """
    rows = _rows(vectors, id_col, vec_col)
    count, dims = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    rows = rows.filter(F.size("v") == (dims or 0))
    block = block or block_rows(count, dims or 0)
    if bits is None:
        bits = lsh_bits(count, near, recall, block) if tables is None else max(2, min(24, round(math.log2(max(1, count) / block))))
    if bits == 0:
        return exact_pairs(rows, near, "id", "v", block)
    if tables is None:
        tables = lsh_tables(near, bits, recall)
    planes = np.random.default_rng(seed).standard_normal((tables, bits, dims or 0))

    @F.arrow_udf("array<int>")
    def buckets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weight = 1 << np.arange(bits)
        for v in batches:
            x = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(v), -1)
            signs = np.einsum("nd,tbd->ntb", x, planes) > 0
            yield pa.array((signs * weight).sum(axis=2).astype(np.int32).tolist(), pa.list_(pa.int32()))

    hashed = rows.withColumn("hs", buckets("v"))
    sizes = hashed.select(F.posexplode("hs").alias("t", "h")).groupBy("t", "h").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).filter("blocks > 1")
    keyed = hashed.select("id", "v", "hs", F.posexplode("hs").alias("t", "h")).join(sizes, ["t", "h"], "left")
    n = F.coalesce("blocks", F.lit(1))
    keyed = keyed.withColumn("n", n).withColumn("b", F.pmod(F.xxhash64("id"), n).cast("int"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda o: F.struct(F.least("b", o).alias("x"), F.greatest("b", o).alias("y"))))
    met = keyed.withColumn("p", pair).select("t", "h", "id", "v", "b", F.slice("hs", F.lit(1), F.col("t")).alias("before"), "p.x", "p.y")
    return met.groupBy("t", "h", "x", "y").applyInArrow(_products(near, True), "a long, b long, distance double")


def neighbours(pairs: DataFrame, k: int = 200) -> DataFrame:
    """(seed, neighbour, distance, rank): of each row the k nearest rows that ``pairs`` has it with, ties by id.

    The nearest k are kept per task before they are ranked, so a row with very many neighbours isn't put in order as a whole.
    """
    ways = F.explode(F.array(F.struct(F.col("a").alias("seed"), F.col("b").alias("neighbour")), F.struct(F.col("b").alias("seed"), F.col("a").alias("neighbour"))))
    both = pairs.select(ways.alias("w"), "distance").select("w.seed", "w.neighbour", "distance")  # the pairs are made once
    rank = F.row_number().over(Window.partitionBy("seed").orderBy("distance", "neighbour"))
    return both.withColumn("rank", rank).filter(F.col("rank") <= k)


def fold(ids: DataFrame, pairs: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """Greedy fold in order of id: (id, seed). A seed is its own; every other row belongs to its smallest adjacent seed.

    This is the sequential star clustering, not connected components: a row is a seed exactly when no smaller
    seed is near. It is found in rounds: a row near to a new seed is a member, and a row whose smaller near rows
    are all members is a new seed. Each round has only the pairs of two rows still open; of all pairs, ids alone are kept.
    """
    rows = ids.select(F.col(id_col).alias("id")).distinct()
    down = open_ = kept(pairs.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("less")), "fold")  # a pair twice changes nothing
    seeds = fresh = cut(rows.join(down.select("id").distinct(), "id", "left_anti"))  # nothing smaller is near
    while not fresh.isEmpty():
        members = cut(open_.join(fresh.select(F.col("id").alias("less")), "less", "left_semi").select("id").distinct())
        left = kept(open_.join(members.select(F.col("id").alias("less")), "less", "left_anti").join(members, "id", "left_anti").select("id", "less"), "fold")
        fresh = cut(open_.select("id").distinct().join(members, "id", "left_anti").join(left.select("id").distinct(), "id", "left_anti"))
        seeds, open_ = cut(seeds.unionByName(fresh)), left
    star = down.join(seeds.select(F.col("id").alias("less")), "less", "left_semi").groupBy("id").agg(F.min("less").alias("seed"))
    return seeds.select("id", F.col("id").alias("seed")).unionByName(star.join(seeds, "id", "left_anti").select("id", "seed"))


def fold_counts(rows: DataFrame, folded: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """Rows with is_duplicate, deduped, and in the seeds the copies of their members added."""
    total = folded.join(rows.select(F.col(id_col).alias("id"), "dup_count"), "id").groupBy("seed").agg(F.sum("dup_count").alias("total"))
    found = rows.join(folded, rows[id_col] == folded["id"], "left").drop("id").join(total, "seed", "left")
    own = F.col("seed") == F.col(id_col)
    return found.withColumn("dup_count", F.when(own, F.col("total")).otherwise(F.col("dup_count"))).withColumn("is_duplicate", ~own).withColumn("deduped", F.lit(True)).drop("total")
