"""SimHash near-duplicates by pigeonhole blocks (operator 7).

Fingerprints are cut into blocks; two that differ in at most ``DISTANCE`` bits agree on all
but ``DISTANCE`` blocks, so they meet under one of the keys made of the blocks left over.
Every pair that meets is verified by its Hamming distance. Inside one key's bucket a
breadth-first search over the distinct fingerprints keeps a spanning forest of the true
links, so copies never become pairs and no link between different texts is lost. A bucket
of more than ``MOST`` fingerprints is dealt out again: of the bits that its key leaves open
further blocks are cut, and the same rule holds for them.

Null and empty texts have fingerprint zero, linked like any other; texts under four words
hash the whole sequence. Repeated rows share a fingerprint and hence a component. Fingerprints
are what is linked, so a row with a null doc_id links others like any row; its component_id
is the smallest doc_id reachable, null only where no row reachable has one. An empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import stars
from plumbline.llm.shared import arrow_map, spare, table, texts_of

WIDTH, DISTANCE, SHINGLE, SEED = 64, 4, 4, 42
#: Distinct fingerprints of a bucket, and how often a larger one is dealt out again: after four times its key leaves
#: open under 14 bits, and so fewer fingerprints than ``MOST``. Any values find every link.
MOST, DEPTH = 20_000, 4
#: Bits are counted over this many shingles at a time, to bound memory on long texts.
_STEP = 4096


def fingerprint(text: bytes) -> int:
    """64 bits, each set where it is set in over half of the shingles' XXH64 values."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    data = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    hashed, seed, cut = xxhash.xxh64_intdigest, SEED, SHINGLE - 1
    counts = np.zeros(WIDTH, np.int64)
    n = len(words) - cut
    for at in range(0, n, _STEP):
        stop = min(at + _STEP, n)
        h = np.array([hashed(data[a:b], seed) for a, b in zip(start[at:stop].tolist(), end[at + cut : stop + cut].tolist(), strict=True)], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def work(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        fp = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return arrow_map(texts_of(docs), work, "doc_id long, fp long")


def blocks_for(n: int) -> int:
    """How many blocks: more of them make longer keys, so that a bucket of n random fingerprints stays small. Any number finds every link."""
    return next((m for m in (6, 7, 8) if n <= 4 << (WIDTH * (m - DISTANCE) // m)), 8)


def block_masks(m: int, given: int = 0) -> list[int]:
    """The bits of each key: every choice of m - DISTANCE of the m blocks that the bits not ``given`` make, and the given ones."""
    free = [i for i in range(WIDTH) if not given >> i & 1]
    block = [sum(1 << i for i in free[len(free) * j // m : len(free) * (j + 1) // m]) for j in range(m)]
    return [given | sum(x) for x in combinations(block, m - DISTANCE)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fp: np.ndarray, near: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among distinct fingerprints, as places (a, b).

    Each place is visited once and compared to those not reached yet, so a dense group costs
    little more than its size, and memory is a few times the group.
    """
    left, one, two = np.arange(len(fp)), [], []
    while len(left) > 1:
        reach, left = [left[0]], left[1:]
        while reach and len(left):
            at = reach.pop()
            close = np.bitwise_count(fp[left] ^ fp[at]) <= near
            if close.any():
                found = left[close]
                one.append(np.full(len(found), at))
                two.append(found)
                reach.extend(found.tolist())
                left = left[~close]
    none = np.zeros(0, np.int64)
    return (np.concatenate(one), np.concatenate(two)) if one else (none, none)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (k, key) -> links inside each bucket. A bucket may span batches."""

    def solve(k: np.ndarray, key: np.ndarray, signed: np.ndarray) -> pa.RecordBatch:
        fp = signed.view(np.uint64)
        change = np.concatenate(([True], (k[1:] != k[:-1]) | (key[1:] != key[:-1])))
        begin = np.flatnonzero(change)
        size = np.diff(np.append(begin, len(k)))
        pairs = begin[size == 2]
        pairs = pairs[np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= DISTANCE]
        a, b = [pairs], [pairs + 1]
        for i, n in zip(begin[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            x, y = forest(fp[i : i + n])
            a.append(x + i)
            b.append(y + i)
        a, b = signed[np.concatenate(a)], signed[np.concatenate(b)]
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["u", "v"])

    held: list[list[np.ndarray]] = []  # parts of the bucket that isn't known to be whole
    last = None
    for batch in batches:
        now = [batch.column(i).to_numpy() for i in range(3)]
        k, key = now[:2]
        if not len(k):
            continue
        edge = np.flatnonzero(np.append(last is not None and last != (k[0], key[0]), (k[1:] != k[:-1]) | (key[1:] != key[:-1])))
        if len(edge):
            whole = [*held, [x[: edge[-1]] for x in now]]
            yield solve(*map(np.concatenate, zip(*whole, strict=True)))
            held = []
        held.append([x[edge[-1] if len(edge) else 0 :] for x in now])
        last = (k[-1], key[-1])
    if held:
        yield solve(*map(np.concatenate, zip(*held, strict=True)))


def _keyed(fp: F.Column, masks: F.Column, first: F.Column) -> F.Column:
    """An array of (k, key), one for each mask."""
    return F.transform(masks, lambda m, i: F.struct((first + i).cast("long").alias("k"), fp.bitwiseAND(m).alias("key")))


def near_links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) -> links (u, v) that span the groups of near ones."""
    level = dict(enumerate(block_masks(blocks_for(fps.count()))))  # the bits of each key, by k
    rows = fps.select(F.explode(_keyed(F.col("fp"), F.array(*(F.lit(_signed(x)) for x in level.values())), F.lit(0))).alias("x"), "fp").select("x.*", "fp")
    done = None
    for depth in range(1, DEPTH + 1):
        large = table(rows.groupBy("k", "key").agg(F.count("*").alias("n")).filter(F.col("n") > MOST).select("k", "key"), "large-buckets")
        used = sorted(r["k"] for r in large.select("k").distinct().collect())  # as many as there are choices of blocks at most
        if not used:
            break
        small = rows.join(large, ["k", "key"], "left_anti")
        done = small if done is None else done.unionByName(small)
        finer = [block_masks(6, level[k]) for k in used]
        place = F.array_position(F.array(*map(F.lit, used)), F.col("k")).cast("int") - 1
        of = F.get(F.array(*(F.array(*(F.lit(_signed(y)) for y in x)) for x in finer)), place)
        first = F.lit(depth * 1_000_000) + place * len(finer[0])
        again = rows.join(large, ["k", "key"], "left_semi").select(F.explode(_keyed(F.col("fp"), of, first)).alias("x"), "fp")
        rows = table(again.select("x.*", "fp"), "dealt-again")
        level = {depth * 1_000_000 + i: y for i, y in enumerate(y for x in finer for y in x)}
    rows = rows if done is None else done.unionByName(rows)
    return rows.repartition("k", "key").sortWithinPartitions("k", "key").mapInArrow(_links, "u long, v long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over near fingerprints."""
    prints = table(fingerprints(docs), "fingerprints")
    fps = table(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = stars(near_links(fps.select("fp"))).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = table(fps.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp: F.Column) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, of which the doc_id is the smallest of its component.

    Rows with a null doc_id are kept: they can't be named as a copy of any. Of rows that repeat a doc_id with
    the same fingerprint one stays per row given; they share the id, hence the decision.
    """
    found = near_duplicates(docs.filter(docs["doc_id"].isNotNull()))
    name = spare(docs, "gone")
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone[name], "left_anti")
