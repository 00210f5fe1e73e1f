"""A kept vector index: inverted files with product codes, appended to without a rebuild, and the fold kept on it.

Vectors are brought to length one and dealt to the cells of a coarse codebook; in its cell a
vector is stored with a product code of what it differs from the cell's centre by. The
codebooks are fitted on a sample of ``SAMPLE`` rows at most (those whose ids have the least
hashes); every row is indexed. The index is a folder of Parquet files by cell, next to a small
table of codebooks, so a later session reads it, and a query reads the files of the cells that
it probes alone.

A search ranks a cell's vectors by asymmetric distance (tables of the query's distances to
the code's entries) and refines the best by their exact distance; where it has a range as well,
it has all of the cell's vectors in that range by products of single floats, and refines those.
It keeps k a block, so what is ranked in the end are k rows for each block that a query meets.
How many cells are probed is fitted on the sample, for ``RECALL`` of its neighbours. A range
search is exact: a cell is left out only where its radius and the triangle inequality say that
it holds nothing near.

Queries and vectors meet in blocks whose number doesn't follow the table's size (until a block
has ``neighbors.BLOCK_BYTES``), so what is sent grows as the table does. Vectors are stored and
sent as the bytes of the floats that were given, single or double.

Rows with a null id or vector, of another length than the first, or with a component that is
null or isn't finite, are left out, as are vectors of zeros, which have no direction. Rows that
repeat an id are indexed each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.operators.neighbors import BLOCKS, block_rows, candidates, exact_pairs, fold
from plumbline.session import cut, kept

#: Rows that the codebooks are fitted on, cells at most, and entries of a part's codebook.
SAMPLE, MOST_CELLS, ENTRIES = 20_000, 4096, 256
#: Share of the sample's neighbours that the probed cells hold; a little more than what is promised of all rows.
RECALL = 0.985
#: Queries and vectors that meet in one task at least, of a bundle of cells that have so many vectors; more in large tables.
QUERIES, VECTORS = 1000, 4000
#: Queries of a block whose neighbours are made at once, and pairs that are held of them before the nearest are picked.
_CHUNK, _HELD = 2048, 1 << 20
#: Distances of queries to centres that are worked on at once.
_AT_ONCE = 1 << 20
#: So many times k rows are refined by exact distance.
REFINE = 4


def lloyd(x: np.ndarray, k: int, rounds: int = 12, seed: int = 42) -> np.ndarray:
    """k centres of the rows of x; a centre that loses all its rows takes the row farthest from its own."""
    rng = np.random.default_rng(seed)
    centres = x[np.sort(rng.choice(len(x), k, replace=False))].copy()
    for _ in range(rounds):
        away = _squared(x, centres)
        own, far = away.argmin(1), away.min(1)
        count = np.bincount(own, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
        empty = np.flatnonzero(count == 0)
        centres[empty] = x[np.argsort(-far, kind="stable")[: len(empty)]]
    return centres


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T, 0)


@dataclass
class Model:
    """Centres of the cells, entries by part, and how many cells a search probes."""

    centres: np.ndarray  # (cell, position)
    entries: np.ndarray  # (part, entry, position within the part)
    probes: int

    def cells(self, x: np.ndarray) -> np.ndarray:
        return _squared(x, self.centres).argmin(1)

    def parts(self, x: np.ndarray) -> np.ndarray:
        """(row, part, position), filled up with zeros."""
        n, _, w = self.entries.shape
        return np.pad(x, ((0, 0), (0, n * w - x.shape[1]))).reshape(len(x), n, w)

    def codes(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        rest = self.parts(x - self.centres[cell])
        return np.stack([_squared(rest[:, j], e).argmin(1) for j, e in enumerate(self.entries)], 1).astype(np.uint8)

    def asymmetric(self, q: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """(query, row): squared distances to what the codes stand for."""
        rest = self.parts(q - self.centres[cell])
        return sum(_squared(rest[:, j], e)[:, codes[:, j]] for j, e in enumerate(self.entries))


def fit(x: np.ndarray, rows: int, k: int = 200, cells: int | None = None, parts: int = 8) -> Model:
    """Codebooks of a sample x of unit vectors, for a table of so many rows."""
    cells = max(1, min(cells or int(rows**0.5), MOST_CELLS, len(x)))
    centres = lloyd(x, cells)
    own = _squared(x, centres).argmin(1)
    width = -(-x.shape[1] // parts)
    rest = np.pad(x - centres[own], ((0, 0), (0, parts * width - x.shape[1]))).reshape(len(x), parts, width)
    entries = np.stack([lloyd(rest[:, j], min(ENTRIES, len(x)), 6) for j in range(parts)])
    asked = x[:: max(1, len(x) // 1000)]
    least = max(1, min(len(x) - 1, -(-k * len(x) // max(rows, 1))))  # of a sample so many are among the k nearest
    near = np.argpartition(_squared(asked, x), least, axis=1)[:, : least + 1]
    order = np.argsort(np.argsort(_squared(asked, centres), axis=1, kind="stable"), axis=1)
    rank = np.take_along_axis(order, own[near], 1)
    return Model(centres, entries, int(np.quantile(rank, RECALL, method="higher")) + 1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _packed(column: pa.Array) -> pa.Array:
    """Vectors of one length as bytes."""
    x = column.flatten().to_numpy(zero_copy_only=False)
    width = x.nbytes // max(1, len(column))
    return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer((np.arange(len(column) + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])


def _unpacked(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors at length one from the bytes of their single or double floats."""
    x, size = np.zeros((len(column), dims)), pc.binary_length(column).to_numpy(zero_copy_only=False)
    for kind in (np.float32, np.float64):
        of = np.flatnonzero(size == dims * np.dtype(kind).itemsize)
        x[of] = np.frombuffer(b"".join(column.take(pa.array(of)).to_pylist()), kind).reshape(len(of), dims)
    return _unit(x)


def _under(near: float, asking: tuple, stored: tuple) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, distance) of the queries and rows under ``near``, tile by tile."""
    (_, q, short_q), (_, v, short_v) = asking, stored
    step = max(1, _AT_ONCE // q.shape[1])
    for i, j in candidates(near, short_q, short_v, False):
        for at in range(0, len(i), step):
            a, b = i[at : at + step], j[at : at + step]
            d = 1.0 - np.einsum("nd,nd->n", q[a], v[b])
            yes = d < near
            yield a[yes], b[yes], d[yes]


def _least(k: int, query: np.ndarray, ids: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of each query, ties by id."""
    order = np.lexsort((ids, d, query))
    own = query[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    order = order[np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)])) < k]
    return query[order], ids[order], d[order]


def _split(key: np.ndarray) -> dict[int, np.ndarray]:
    """Places of each value."""
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0]) if len(key) else np.zeros(0, np.int64)
    return dict(zip(key[order[first]].tolist(), np.split(order, first[1:]), strict=True)) if len(key) else {}


def _usable(v: Column) -> Column:
    big = F.lit(1e150)  # neither infinite nor a NaN, which is larger than all numbers, nor too large to square
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(F.abs(x) < big, F.lit(False))) & F.exists(v, lambda x: x != 0)


class VectorIndex:
    """The index in a folder; ``path`` must be one that the driver and all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        rows = spark.read.parquet(f"{self.path}/model").collect()  # as many numbers as the codebooks have
        shape = {r["kind"]: r["shape"] for r in rows}
        values = {k: np.array([r["v"] for r in sorted(rows, key=lambda r: r["i"]) if r["kind"] == k]).reshape(s) for k, s in shape.items()}
        self.model = Model(values["centres"], values["entries"], int(values["probes"].flat[0]))
        self.dims = self.model.centres.shape[1]

    @classmethod
    def build(cls, vectors: DataFrame, path: str, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 200, cells: int | None = None, parts: int = 8) -> VectorIndex:
        """Fit the codebooks, write them, and index the rows given."""
        spark, path = vectors.sparkSession, path.rstrip("/")
        rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).filter("id is not null").filter(_usable(F.col("v")))
        head = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
        if not head:
            raise ValueError("no vector to fit an index on")
        dims = len(head[0]["v"])
        x = _unit(np.array([r["v"] for r in head if len(r["v"]) == dims], np.float64))
        model = fit(x, rows.count(), k, cells, parts)
        wide = lambda kind, a: [(kind, i, list(a.shape), r.tolist()) for i, r in enumerate(a.reshape(-1, a.shape[-1]))]
        table = [*wide("centres", model.centres), *wide("entries", model.entries), *wide("probes", np.array([[float(model.probes)]]))]
        spark.createDataFrame(table, "kind string, i int, shape array<int>, v array<double>").coalesce(1).write.parquet(f"{path}/model")
        index = cls(spark, path)
        index.append(vectors, id_col, vec_col)
        return index

    def _rows(self, vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
        kind = "array<float>" if vectors.select(vec_col).schema[0].dataType.simpleString() == "array<float>" else "array<double>"
        rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("v"))
        return rows.filter("id is not null").filter(_usable(F.col("v")) & (F.size("v") == self.dims))

    def append(self, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> None:
        """Add rows to their cells' files; the codebooks stay."""
        model = self.model

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, _AT_ONCE // max(len(model.centres), ENTRIES))
            for batch in batches:
                for i in range(0, batch.num_rows, step):
                    b = batch.slice(i, step)
                    x = _unit(_matrix(b.column("v")))
                    cell = model.cells(x)
                    away = np.sqrt(((x - model.centres[cell]) ** 2).sum(1))
                    yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), b.column("id"), pa.array(away), pa.array([c.tobytes() for c in model.codes(x, cell)], pa.binary()), _packed(b.column("v"))], names=["cell", "id", "away", "code", "v"])

        rows = self._rows(vectors, id_col, vec_col).mapInArrow(coded, "cell int, id long, away double, code binary, v binary")
        rows.hint("rebalance", "cell").write.mode("append").partitionBy("cell").parquet(f"{self.path}/rows")

    def rows(self, cells: list[int] | None = None) -> DataFrame:
        """What is stored; of some cells alone, without a look at the others' files."""
        kind = "id long, away double, code binary, v binary, cell int"
        found = self.spark.read.schema(kind).parquet(f"{self.path}/rows")
        return found if cells is None else found.filter(F.col("cell").isin(cells))

    def _probed(self, near: float | None, probes: int | None):
        """Which cells a query visits, as a function of vectors to (vector, cell): the nearest ``probes`` or all that can hold a vector under ``near``."""
        model = self.model
        reach = {}
        if probes is None:
            reach = {r["cell"]: r["m"] for r in self.rows().groupBy("cell").agg(F.max("away").alias("m")).collect()}  # a number a cell
        radius = np.array([reach.get(c, -np.inf) for c in range(len(model.centres))])

        def probed(x: np.ndarray) -> np.ndarray:
            away = np.sqrt(_squared(x, model.centres))
            if probes is None:
                return away <= np.sqrt(2 * near) + radius + 1e-6
            hit = np.zeros(away.shape, bool)
            np.put_along_axis(hit, np.argsort(away, axis=1, kind="stable")[:, :probes], True, 1)
            return hit

        return probed

    def _visits(self, queries: DataFrame, id_col: str, vec_col: str, near: float | None, probes: int | None, bundle: np.ndarray | None = None, probed=None) -> DataFrame:
        """(query, q, cells, bundle): the cells that each query visits, in a row for each bundle (or cell)."""
        model, probed = self.model, probed or self._probed(near, probes)
        bundle = np.arange(len(model.centres), dtype=np.int32) if bundle is None else bundle

        def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, _AT_ONCE // len(model.centres))
            for b in (batch.slice(i, step) for batch in batches for i in range(0, batch.num_rows, step)):
                row, cell = np.nonzero(probed(_unit(_matrix(b.column("v")))))  # in order of cells, and so of bundles
                group, q = bundle[cell], _packed(b.column("v"))
                first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (group[1:] != group[:-1])]) if len(row) else np.zeros(0, np.int64)
                cells = pa.ListArray.from_arrays(pa.array(np.r_[first, len(row)].astype(np.int32)), pa.array(cell.astype(np.int16)))
                for i in range(0, len(first), step):  # a vector for each bundle, not for each cell
                    of = pa.array(row[first[i : i + step]])
                    yield pa.RecordBatch.from_arrays([b.column("id").take(of), q.take(of), cells.slice(i, len(of)), pa.array(group[first[i : i + step]])], names=["query", "q", "cells", "bundle"])

        return self._rows(queries, id_col, vec_col).mapInArrow(visits, "query long, q binary, cells array<smallint>, bundle int")

    def _sizes(self) -> dict[int, int]:
        return {r["cell"]: r["count"] for r in self.rows().groupBy("cell").count().collect()}  # a number a cell

    def _bundles(self, sizes: dict[int, int] | None = None) -> np.ndarray:
        """The bundle of each cell: neighbours in number, put together while they have no more vectors than a block."""
        sizes = self._sizes() if sizes is None else sizes
        most = max(VECTORS, block_rows(sum(sizes.values()), self.dims))
        out, bundle, held = np.zeros(len(self.model.centres), np.int32), 0, 0
        for c in range(len(out)):
            n = sizes.get(c, 0)
            if held and held + n > most:
                bundle, held = bundle + 1, 0
            out[c], held = bundle, held + n
        return out

    def _census(self, asked: DataFrame, probed, bundle: np.ndarray) -> tuple[list[int], np.ndarray]:
        """The cells that any query visits, and how many queries each bundle has."""
        cells, step = len(bundle), max(1, _AT_ONCE // len(bundle))
        first = np.flatnonzero(np.r_[True, bundle[1:] != bundle[:-1]])

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            visited, queries = np.zeros(cells, np.int64), np.zeros(len(first), np.int64)
            for b in (batch.slice(i, step) for batch in batches for i in range(0, batch.num_rows, step)):
                hit = probed(_unit(_matrix(b.column("v"))))
                visited += hit.sum(0)
                queries += np.logical_or.reduceat(hit, first, axis=1).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells + len(first), dtype=np.int32)), pa.array(np.r_[visited, queries])], names=["i", "n"])

        total = np.zeros(cells + len(first), np.int64)
        for r in asked.mapInArrow(counted, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():  # two numbers a cell at most
            total[r["i"]] = r["n"]
        return np.flatnonzero(total[:cells]).tolist(), total[cells:]

    def _met(self, queries: DataFrame, id_col: str, vec_col: str, near: float | None, probes: int | None, work, k: int | None = None, coded: bool = False) -> DataFrame:
        """(query, neighbour, distance): what ``work`` yields of a block of queries and a block of a bundle's vectors, cell by cell; each two blocks meet in one task, which keeps ``k``.

        ``work`` gets the ids, vectors and vectors in single floats of a cell's queries and of its rows, the cell and its codes.
        """
        dims, sizes = self.dims, self._sizes()
        bundle = self._bundles(sizes)
        asked = kept(self._rows(queries, id_col, vec_col).repartition("id"), "asked")  # read twice, and dealt to all cores
        probed = self._probed(near, probes)
        cells, queried = self._census(asked, probed, bundle)
        held = np.bincount(bundle, [sizes.get(c, 0) for c in range(len(bundle))], len(queried))
        nx = np.ceil(queried / max(QUERIES, block_rows(int(queried.max()), dims))).astype(int)
        ny = np.ceil(held / max(VECTORS, block_rows(sum(sizes.values()), dims))).astype(int)
        of = lambda a: F.element_at(F.lit(a.tolist()), F.col("bundle") + 1)
        upto = lambda n: F.explode(F.sequence(F.lit(0), F.greatest(of(n), F.lit(1)) - 1))
        block = lambda n: F.pmod(F.xxhash64("id"), F.greatest(of(n), F.lit(1))).cast("int")
        left = self._visits(asked, "id", "v", near, probes, bundle, probed).select("bundle", F.col("query").alias("id"), F.col("q").alias("v"), F.lit(None).cast("int").alias("cell"), "cells", F.lit(None).cast("binary").alias("code"))
        right = self.rows(cells).withColumn("bundle", F.element_at(F.lit(bundle.tolist()), F.col("cell") + 1))
        right = right.select("bundle", "id", "v", "cell", F.lit(None).cast("array<smallint>").alias("cells"), (F.col("code") if coded else F.lit(None).cast("binary")).alias("code"))
        both = left.withColumn("x", block(nx)).withColumn("y", upto(ny)).unionByName(right.withColumn("y", block(ny)).withColumn("x", upto(nx)))
        tasks = int(min(max(1, (nx * ny).sum()), 4 * BLOCKS**2))

        def by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(batches).select(["id", "v", "cell", "cells", "code"]).combine_chunks()
            asks = pc.is_null(t.column("cell"))
            left, right = t.filter(asks), t.filter(pc.invert(asks))
            del t
            query, ids, own = left.column("id").to_numpy(), right.column("id").to_numpy(), _split(right.column("cell").to_numpy())
            q, v = (_unpacked(s.column("v").combine_chunks(), dims) for s in (left, right))
            short_q, short_v = q.astype(np.float32), v.astype(np.float32)
            codes = np.frombuffer(b"".join(right.column("code").to_pylist()), np.uint8).reshape(len(ids), -1) if coded and len(ids) else None
            del right
            stored = {c: (ids[at], v[at], short_v[at]) for c, at in own.items()}
            del v, short_v
            batch = lambda a, b, d: pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(d)], names=["query", "neighbour", "distance"])
            for start in range(0, len(query), _CHUNK):
                lists = left.column("cells").slice(start, _CHUNK).combine_chunks()
                row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False)) + start
                best: list[tuple] = []
                count = 0
                for c, at in _split(lists.flatten().to_numpy(zero_copy_only=False)).items():
                    if c not in own:
                        continue
                    asking = row[at]
                    for i, j, d in work((query[asking], q[asking], short_q[asking]), stored[c], c, None if codes is None else codes[own[c]]):
                        found = query[asking[i]], stored[c][0][j], d
                        if k is None:
                            yield batch(*found)
                            continue
                        best.append(found)
                        count += len(d)
                        if count > _HELD:
                            best = [_least(k, *(np.concatenate(b) for b in zip(*best, strict=True)))]
                            count = len(best[0][0])
                if best:
                    yield batch(*_least(k, *(np.concatenate(b) for b in zip(*best, strict=True))))

        return both.repartition(tasks, "bundle", "x", "y").groupBy("bundle", "x", "y").applyInArrow(by_cell, "query long, neighbour long, distance double")

    def search(self, queries: DataFrame, k: int = 200, near: float | None = None, probes: int | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
        """(query, neighbour, distance, rank): about the k nearest other vectors of each query by cosine distance, ties by id."""
        model, most = self.model, REFINE * k

        def nearest(asking: tuple, stored: tuple, cell: int, codes: np.ndarray) -> Iterator[tuple]:
            (query, q, _), (ids, v, _) = asking, stored
            if near is not None:
                for i, j, d in _under(near, asking, stored):
                    other = query[i] != ids[j]
                    yield i[other], j[other], d[other]
                return
            for at in range(0, len(q), 64):
                some = q[at : at + 64]
                short = np.broadcast_to(np.arange(len(ids)), (len(some), len(ids)))
                if len(ids) > most:
                    short = np.argpartition(model.asymmetric(some, cell, codes), most, axis=1)[:, :most]
                for i, (one, of) in enumerate(zip(some, short, strict=True), at):
                    of = of[ids[of] != query[i]]
                    d = 1.0 - v[of] @ one
                    order = np.lexsort((ids[of], d))[:k]
                    yield np.full(len(order), i), of[order], d[order]

        found = self._met(queries, id_col, vec_col, None, min(probes or model.probes, len(model.centres)), nearest, k, near is None)
        rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "neighbour"))
        return found.withColumn("rank", rank).filter(F.col("rank") <= k)

    def within(self, queries: DataFrame, near: float, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
        """(query, neighbour, distance): all stored vectors under ``near`` of each query, itself among them where it is stored. Exact."""

        def close(asking: tuple, stored: tuple, cell: int, codes: np.ndarray) -> Iterator[tuple]:
            return _under(near, asking, stored)

        return self._met(queries, id_col, vec_col, near, None, close)


class OnlineFold:
    """The greedy fold in order of id, kept between batches: its seeds are a vector index, what was folded is a table.

    A new row belongs to its smallest near seed; rows without one are folded among themselves, and their seeds
    join the index. So after each batch the result is that of one fold over all rows so far. Ids of a
    batch must be larger than those before it: the order is part of the result. A batch is folded once its rows are
    written, so a run that dies after its seeds but before its rows may be repeated: seeds are looked up among ids below
    the batch's own.
    """

    def __init__(self, spark: SparkSession, path: str, near: float, id_col: str = "vec_id", vec_col: str = "embedding"):
        self.spark, self.path, self.near, self.id_col, self.vec_col = spark, path.rstrip("/"), near, id_col, vec_col
        self.seeds: VectorIndex | None = None
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/seeds/model/_SUCCESS")
        if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
            self.seeds = VectorIndex(spark, f"{self.path}/seeds")

    def folded(self) -> DataFrame:
        """(id, seed) of all rows so far."""
        return self.spark.read.schema("id long, seed long").parquet(f"{self.path}/folded")

    def add(self, batch: DataFrame) -> None:
        """Fold one batch."""
        rows = batch.select(F.col(self.id_col).cast("long").alias("id"), F.col(self.vec_col).alias("v")).filter("id is not null").filter(_usable(F.col("v")))
        rows = cut(rows)
        first = rows.agg(F.min("id")).first()[0]
        if first is None:
            return
        taken = None
        if self.seeds is not None:
            last = self.folded().agg(F.max("id")).first()[0]
            if last is not None and last >= first:
                raise ValueError(f"ids must be larger than {last}, which is folded already")
            found = self.seeds.within(rows, self.near, "id", "v").filter(F.col("neighbour") < first)
            taken = cut(found.groupBy(F.col("query").alias("id")).agg(F.min("neighbour").alias("seed")))
        rest = rows if taken is None else cut(rows.join(taken, "id", "left_anti"))
        own = cut(fold(rest, exact_pairs(rest, self.near, "id", "v"), "id"))
        fresh = rest.join(own.filter("id = seed").select("id"), "id", "left_semi")
        if self.seeds is None:
            self.seeds = VectorIndex.build(fresh, f"{self.path}/seeds", "id", "v")
        else:
            self.seeds.append(fresh, "id", "v")
        (own if taken is None else own.unionByName(taken)).write.mode("append").parquet(f"{self.path}/folded")
