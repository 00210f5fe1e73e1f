"""Vector code compression with VA-file filtering (operator 13).

A vector's components become integers, floor(``SCALE`` x), and the vector is cut into
``PARTS`` equal parts. Each part position has a codebook of ``ENTRIES`` entries; a vector is
stored as the indexes of the entries nearest to its parts. Codebooks start as the parts of
the vectors with the smallest ids and are moved ``rounds`` times: every part goes to its
nearest entry (ties to the lower index), every entry to the floor of its parts' mean; an
entry that none went to stays.

Nearest entries are found as in a VA-file. Each coordinate of a codebook is quantised to
``BITS`` bits, so an entry is a row of cells. For each part to be coded a lookup table holds
its least and its greatest squared distance to every cell of every coordinate; the sums over
an entry's cells bound its distance from below and from above. Only entries whose lower bound
doesn't exceed the least upper bound are refined, by integer distances. The bounds hold for
integers exactly, so no nearest entry is filtered out.

A round is one pass over the table: each task sums its vectors by part and entry, so what is
shuffled are ``ENTRIES`` times the vector's length numbers a task, and what the driver gets is
that once. Codebooks (as many numbers) go to the tasks with the code.

Rows are left out whose vector is null, empty, or holds a null or non-finite component; also,
since the integers must be of a fixed width, one of 2^15 or more in magnitude, and vectors of
another length than that of the smallest id that is kept. A length that isn't a multiple of
``PARTS`` is filled up with zeros. Rows with a null id are coded and counted, and come last
among the first codebook's rows; of rows that repeat an id the smaller vector comes first.
With fewer rows than ``ENTRIES`` the codebooks have as many entries as there are rows. An
empty table gives no rows. Only the columns named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import spare, table

PARTS, ENTRIES, ROUNDS, SCALE, BITS = 8, 16, 6, 4096, 3
#: Components of this magnitude or more have no integer of the width used.
LIMIT = float(1 << 15)
#: Vectors worked on at a time, to bound a worker's memory.
_STEP = 4096
#: Sums of squares up to here are whole in floating point.
_WHOLE = 1 << 53


class Codebook:
    """The entries of one part position, with their cells."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries  # (entry, position)
        low = entries.min(0)
        width = (entries.max(0) - low >> BITS) + 1
        cell = (entries - low) // width
        self.low = low[:, None] + np.arange(1 << BITS) * width[:, None]  # (position, cell), both ends inclusive
        self.high = self.low + width[:, None] - 1
        self.pick = (cell.T[:, :, None] == np.arange(1 << BITS)).transpose(0, 2, 1).reshape(-1, len(entries))  # (position and cell, entry)

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the squared distance of each x to each entry, by lookup tables."""
        below, above = self.low - x[:, :, None], x[:, :, None] - self.high
        near = np.maximum(np.maximum(below, above), 0)
        far = np.maximum(np.abs(below), np.abs(above))
        n = x.shape[1]
        kind = np.float64 if n * int(far.max(initial=0)) ** 2 < _WHOLE else np.int64
        pick = self.pick.astype(kind)
        return tuple((t.astype(kind) ** 2).reshape(len(x), -1) @ pick for t in (near, far))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each x and the squared distance to it."""
        lower, upper = self.bounds(x)
        row, entry = np.nonzero(lower <= upper.min(1)[:, None])
        distance = ((x[row] - self.entries[entry]) ** 2).sum(1)
        begin = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(distance, begin) if len(x) else distance
        hit = np.flatnonzero(distance == least[row])
        first = np.unique(row[hit], return_index=True)[1]  # entries ascend within a row
        return entry[hit[first]], least


class Codebooks:
    """One codebook per part position; ``dims`` is the length of the vectors that they code."""

    def __init__(self, entries: np.ndarray, dims: int):
        self.entries, self.dims = entries, dims  # (part, entry, position)
        self.parts = [Codebook(e) for e in entries]

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, as decimals joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def cut(self, x: np.ndarray) -> np.ndarray:
        return _cut(x, len(self.parts))

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, part) -> the indexes and the squared distances."""
        of = [book.nearest(x[:, j]) for j, book in enumerate(self.parts)]
        return np.stack([a for a, _ in of], 1), np.stack([d for _, d in of], 1)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Indexes (vector, part) -> the vectors that they stand for."""
        whole = np.concatenate([book.entries[codes[:, j]] for j, book in enumerate(self.parts)], 1)
        return whole[:, : self.dims] / SCALE


def _cut(x: np.ndarray, parts: int) -> np.ndarray:
    """(vector, component) -> (vector, part, position)."""
    return np.pad(x, ((0, 0), (0, -x.shape[1] % parts))).reshape(len(x), parts, -(-x.shape[1] // parts))


def _whole(vectors: pa.ListArray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are kept, and those as integers."""
    size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    keep = size == dims
    x = values[np.repeat(keep, size)].reshape(-1, dims)
    fine = (np.abs(x) < LIMIT).all(1)
    keep[keep] = fine
    return keep, np.floor(SCALE * x[fine]).astype(np.int64)


def _usable(vector: Column) -> Column:
    """What ``_whole`` keeps, whatever the length."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x) < LIMIT, F.lit(False)))  # a NaN is the largest of all numbers
    return vector.isNotNull() & (F.size(vector) > 0) & fine


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """Codebooks of the smallest ids' parts, in order of id; None where no row is kept."""
    rows = vectors.filter(_usable(F.col("vector")))
    order = (F.col("id").asc_nulls_last(), F.col("vector"))
    head = rows.orderBy(*order).limit(1).collect()
    if not head:
        return None
    dims = len(head[0]["vector"])
    heads = rows.filter(F.size("vector") == dims).orderBy(*order).limit(entries).collect()
    x = np.floor(SCALE * np.array([r["vector"] for r in heads], np.float64)).astype(np.int64)
    return Codebooks(np.ascontiguousarray(_cut(x, parts).transpose(1, 0, 2)), dims)


def _sums(books: Codebooks, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's vectors, counted and summed by part and entry."""
    shape = books.entries.shape
    total, count = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, _STEP):
            _, x = _whole(batch.column("vector").slice(at, _STEP), books.dims)
            x = books.cut(x)
            codes, _ = books.assign(x)
            for j, of in enumerate(codes.T):
                count[j] += np.bincount(of, minlength=shape[1])
                for e in np.unique(of):
                    total[j, e] += x[of == e, j].sum(0)
    part, entry = np.nonzero(count)
    if len(part):
        sums = pa.FixedSizeListArray.from_arrays(pa.array(total[part, entry].ravel()), shape[2]).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), sums], names=["part", "entry", "n", "sums"])


def moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round."""
    found = vectors.mapInArrow(lambda batches: _sums(books, batches), "part int, entry int, n long, sums array<long>")
    found = found.select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
    rows = found.groupBy("part", "entry", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect()
    entries = books.entries.copy()
    for r in rows:
        entries[r["part"], r["entry"], r["at"]] = r["x"] // r["n"]
    return Codebooks(entries, books.dims)


def _vectors(df: DataFrame, id_col: str, vector_col: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), *keep)


def train(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of the whole table; None where no row is kept."""
    vectors = _vectors(df, id_col, vector_col)
    books = first_books(vectors)
    for _ in range(rounds if books else 0):
        books = moved(vectors.select("vector"), books)
    return books


def encode(df: DataFrame, books: Codebooks, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, code, error) of the rows that are kept: two hex digits a part, and the squared distance of the whole vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _STEP):
                part = batch.slice(at, _STEP)
                keep, x = _whole(part.column("vector"), books.dims)
                codes, distance = books.assign(books.cut(x))
                digits, step = codes.astype(np.uint8).tobytes().hex(), 2 * codes.shape[1]
                kept = part.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays([kept.column("id"), kept.column("label"), pa.array([digits[i : i + step] for i in range(0, len(digits), step)], pa.string()), pa.array(distance.sum(1))], names=["id", "label", "code", "error"])

    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256): label_error is summed over rows of equal label, nulls together."""
    books = train(df, id_col, vector_col, rounds)
    if books is None:
        return df.limit(0).select(F.col(id_col), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = table(encode(df, books, id_col, vector_col, label_col), "codes")
    of = spare(coded, "of")
    sums = coded.groupBy(F.col("label").alias(of)).agg(F.sum("error").alias("label_error"))
    joined = coded.join(sums, coded["label"].eqNullSafe(sums[of]))
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def oracle(rounds: int = ROUNDS) -> str:
    """DuckDB SQL for ``compress`` over the table embeddings, one step of the codebooks after another."""
    steps = [
        f"""q as materialized (select vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (select vec_id, j, v[(j * len(v) / {PARTS})::bigint + 1:((j + 1) * len(v) / {PARTS})::bigint] as x from q, (select unnest(range({PARTS})) as j)),
c0 as materialized (select j, row_number() over (partition by j order by vec_id) - 1 as e, x as y from p where vec_id in (select vec_id from q order by vec_id limit {ENTRIES}))"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""a{k} as materialized (select vec_id, j, x, min({{'d': d, 'e': e}}) as b from
  (select vec_id, p.j, x, e, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i])))::bigint as d from p join c{k} c on p.j = c.j) group by vec_id, j, x)"""
        )
        if k < rounds:
            steps.append(
                f"""c{k + 1} as materialized (select c.j, c.e, coalesce(m.y, c.y) as y from c{k} c left join (select j, e, list(s order by i) as y from
  (select j, e, i, floor(sum(v)::double / count(*))::bigint as s from (select j, b.e as e, unnest(range(len(x))) as i, unnest(x) as v from a{k}) group by j, e, i) group by j, e) m on c.j = m.j and c.e = m.e)"""
            )
    steps.append(f"o as (select vec_id, string_agg(printf('%02x', b.e), '' order by j) as code, sum(b.d)::bigint as error from a{rounds} group by vec_id)")
    steps.append(f"h as (select sha256(string_agg(array_to_string(y, ','), ',' order by j, e)) as s from c{rounds})")
    return "with " + ",\n".join(steps) + "\nselect vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, (select s from h) as codebooks_sha256 from o join q using (vec_id)"
