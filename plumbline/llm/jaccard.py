"""Size-aware heavy-light join of shingle sets by Jaccard similarity (operator 12).

Two sets of sizes n and m link when 100 |both| >= PERCENT |either|. All elements have one
global order: light ones before heavy ones (those in more than ``MOST`` sets), then by hash.
Linked sets share k elements or more among their first n - c(n) + k, where c(n) is the least
number that a set of n elements can share with a linked one. So

* small sets (up to a boundary) enumerate the subsets of two elements of that prefix with
  k = 2; two small sets that link have a subset in common, and few others do;
* large sets are looked up in inverted lists of the single elements of their prefix with
  k = ``wanted``, which also list the small sets that are large enough to link with a large
  one; a set that is in fewer shared lists than its partners' k links with none and leaves them.

The boundary is where the cost is least: rows to enumerate for sets of each size against rows
to list and pairs to scan, by the lengths of the lists. Any boundary finds every link.

Equal sets are folded to one first. Lists are not expanded into pairs. In two rounds their
sets are compared by exact intersection, and a list yields a spanning forest of its links:
first every set in its longest and its shortest list, cut into chunks of ``MOST`` that share
one leader, which joins most groups of near copies; then, in each list that still has sets of
different components, those of different ones. There sets come as sketches first: the parity
of their elements in each of ``SKETCH`` cells or more. Two sketches differ in no more cells than their
sets have elements that the other lacks, so only sets that may link with one of another
component are compared as a whole. A list of more than ``MOST`` is dealt out in pairs of
blocks: its largest component's against the others', and these against each other. No list
is too long, and no pair is skipped but those that are connected or can't link.

Texts under ``SHINGLE`` words are one element; those without words are empty and link with
nothing, but keep a component of their own. Null texts count as empty. Rows with a null id
link like others and have their component's smallest id, null if no row has one. Rows that
repeat an id are judged each by its text. Texts of any length are taken whole. An empty table
gives no rows; other columns are not read. Elements and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.bits import bitmap, has
from plumbline.llm.components import stars
from plumbline.llm.shared import drop, slices, table, texts_of, trim
from plumbline.llm.words import Words, grams, mix

SHINGLE, PERCENT = 4, 85
#: Sets above which an element counts as heavy and a list is dealt out in blocks. Any value finds every link.
MOST = 256
#: Cost of one row of a list, in steps of comparing two sets, of which a pair takes as many as it has elements.
ROW = 3000
#: Lists in which a set is compared for certain; the others are only looked at where they are still open.
SCANNED = 2
_CLASSES = 64
#: Cells of a sketch at least; a larger set has the power of two above its size.
SKETCH = 2048
#: How often sets in too few lists are looked for; any number of times finds every link.
_LEAVE = 2
#: Of so many elements of the plain prefix one more is asked for.
_MORE = 4


def shared_least(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The least number of elements that linked sets of n and m elements share."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def smallest(n: np.ndarray) -> np.ndarray:
    """The size of the smallest set that one of n elements can link to."""
    return -(-PERCENT * n // 100)


def prefix_size(n: np.ndarray) -> np.ndarray:
    """How many first elements of a set have one at least in common with every set that it links to; none if it can only link to its equals."""
    n = np.asarray(n)
    return np.where(n < smallest_linking(), 0, n - shared_least(n, smallest(n)) + 1)


def smallest_linking() -> int:
    """Sets of fewer elements link to their equals alone."""
    return -(-PERCENT // (100 - PERCENT))


def wanted(n: np.ndarray) -> np.ndarray:
    """How many lists of a set of n elements count as its prefix's k."""
    return 1 + prefix_size(n) // _MORE


def needed(n: np.ndarray) -> np.ndarray:
    """In how many lists a set meets each set that it links to, whose own k may be smaller. As sizes grow a prefix shrinks by one at most."""
    return 1 + np.maximum(prefix_size(smallest(n)) - 1, 0) // _MORE


def listed_size(n: np.ndarray) -> np.ndarray:
    """Length of the prefix for k = ``wanted``, and for subsets of two at least."""
    long = prefix_size(n)
    return np.where(long, np.minimum(long + np.maximum(wanted(n) - 1, 1), n), 0)


class Sets:
    """The shingle sets of a list of texts: set d has the elements ``h[first[d]:first[d+1]]`` in ascending order."""

    def __init__(self, texts: list[bytes]):
        w = Words([t.lower() for t in texts])
        words = w.hashes()
        at = np.flatnonzero(w.rest()[: max(len(words) - SHINGLE + 1, 0)] >= SHINGLE)
        h, d = grams(words, SHINGLE)[at], w.doc[at]
        for k in range(1, SHINGLE):  # whole sequences
            few = np.flatnonzero(w.count == k)
            h = np.concatenate((h, grams(words, k)[w.first[few]] if len(few) else h[:0]))
            d = np.concatenate((d, few))
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        once = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))[: len(h)]
        self.h, self.doc = h[once], d[once]
        self.size = np.bincount(self.doc, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.size)))

    def names(self) -> np.ndarray:
        """A hash of each whole set."""
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.h))))
        return mix(total[self.first[1:]] - total[self.first[:-1]] + self.size.astype(np.uint64))


def _rows(s: Sets, keep: np.ndarray, values: np.ndarray) -> pa.Array:
    """``values`` as one list for each set, of the elements that ``keep`` names."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(s.doc[keep], minlength=len(s.size))))).astype(np.int32)), pa.array(values.view(np.int64)))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _prefixes(heavy: np.ndarray | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: the size and the name of its set, the lists that it needs, and the prefix in the global order."""
    for part, texts in slices(batches):
        s = Sets(texts)
        late = np.zeros(len(s.h), bool) if heavy is None else has(heavy, s.h)
        order = np.lexsort((s.h, late, s.doc))
        nth = np.arange(len(order)) - s.first[s.doc]
        keep = np.flatnonzero(nth < listed_size(s.size)[s.doc])
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s.size.astype(np.int64)), _signed(s.names()), pa.array(needed(s.size).astype(np.int32)), _rows(s, keep, s.h[order[keep]])], names=["doc_id", "n", "node", "need", "prefix"])
    trim()


def size_class(n: Column | np.ndarray) -> Column | np.ndarray:
    """Classes of size: four to each doubling."""
    if isinstance(n, Column):
        return F.least(F.floor(4 * F.log2(n)), F.lit(_CLASSES * 4)).cast("int")
    return np.minimum(np.floor(4 * np.log2(n)), _CLASSES * 4).astype(int)


def boundary(sets: dict[int, tuple[int, float]], pairs: dict[int, float]) -> int:
    """The largest size that counts as small, by cost. ``sets``: number and mean size by class; ``pairs``: pairs in lists by class."""
    classes = sorted(sets)
    size = np.array([sets[c][1] for c in classes])
    long = prefix_size(np.round(size).astype(np.int64)).astype(float)
    number = np.array([float(sets[c][0]) for c in classes])
    small = number * long * (long + 1) / 2 * ROW
    large = number * long * ROW + np.array([pairs.get(c, 0.0) for c in classes]) * size * np.minimum(1, SCANNED / np.maximum(long, 1))
    costs = [small[:i].sum() + large[i:].sum() for i in range(len(classes) + 1)]
    best = int(np.argmin(costs)) if costs else 0
    return int(2 ** ((classes[best - 1] + 1) / 4)) - 1 if best else 0


def _keys(small: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, prefix) -> one row for each subset or list of the set."""
    from_lists = smallest(small + 1)
    for batch in batches:
        nodes, sizes = (batch.column(c).to_numpy() for c in ("node", "n"))
        lists = batch.column("prefix")
        flat, offset = lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
        keys, rows = [], []
        for i in np.flatnonzero(np.diff(offset)).tolist():
            x, long = flat[offset[i] : offset[i + 1]], int(prefix_size(sizes[i]))
            if sizes[i] <= small:
                a, b = np.triu_indices(long + 1, 1)
                keys.append(mix(mix(x[a]) + x[b]))
                rows.append(np.full(len(a), i))
            if sizes[i] >= from_lists:
                keys.append(x[: long + int(wanted(sizes[i])) - 1])
                rows.append(np.full(len(keys[-1]), i))
        if keys:
            at = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays([_signed(np.concatenate(keys)), pa.array(nodes[at])], names=["key", "node"])
    trim()


def _whole(live: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, sketch, elements) of the sets that are live; each task gives a set once."""
    seen: set[int] = set()
    for _, texts in slices(batches):
        s = Sets(texts)
        names = s.names()
        at = [i for i in np.flatnonzero(has(live, names) & (prefix_size(s.size) > 0)).tolist() if names[i] not in seen]
        at = list({names[i]: i for i in at}.values())
        seen.update(names[at])
        if at:
            sets = [s.h[s.first[i] : s.first[i + 1]] for i in at]
            yield pa.RecordBatch.from_arrays([_signed(names[at]), pa.array(s.size[at].astype(np.int32)), pa.array(map(sketch, sets), pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "n", "sketch", "elements"])
    trim()


def sketch(elements: np.ndarray) -> bytes:
    """Whether the number of elements in each cell is odd."""
    size = max(SKETCH, 1 << (len(elements) - 1).bit_length())
    cells = np.bincount((elements >> np.uint64(20) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(cells.astype(np.uint8)).tobytes()


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, block), with sketches -> those that may link with one of another component in their block."""
    names = ["key", "block", "node", "root"]
    for _, group in groupby(_each(batches, [*names, "n", "sketch"]), lambda r: r[:2]):
        rows = list(group)
        root, n, width = np.array([r[3] for r in rows]), np.array([r[4] for r in rows]), np.array([len(r[5]) for r in rows])
        yes = np.zeros(len(rows), bool)
        for w in np.unique(width).tolist():
            own, wide = np.flatnonzero(width == w), np.flatnonzero(width == 2 * w)  # sets that link are of one width, or of this and the next
            both = np.concatenate((own, wide))
            bits = [np.frombuffer(rows[i][5], np.uint64) for i in both]
            bits = np.stack([x if len(x) == w // 8 else x[: w // 8] ^ x[w // 8 :] for x in bits])  # half the cells
            for i, at in enumerate(own):
                rest = both[i + 1 :]
                near = np.flatnonzero((root[rest] != root[at]) & (100 * np.minimum(n[rest], n[at]) >= PERCENT * np.maximum(n[rest], n[at])))
                if len(near):
                    m = n[rest[near]]
                    apart = np.bitwise_count(bits[i + 1 + near] ^ bits[i]).sum(1, dtype=np.int64)
                    hit = rest[near[apart <= m + n[at] - 2 * shared_least(m, n[at])]]
                    yes[hit] = True
                    yes[at] |= len(hit) > 0
        if yes.any():
            kept = [r for r, y in zip(rows, yes.tolist(), strict=True) if y]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in kept], pa.string() if i == 1 else pa.int64()) for i in range(4)], names=names)
    trim()


def _each(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def forest(sets: list[np.ndarray], root: np.ndarray) -> list[tuple[int, int]]:
    """Links, as places, that together with equal roots span the groups that all links make.

    A place is visited once and compared to those not reached yet; places of one root are reached together.
    """
    if len(sets) == 2:
        x, y = sets
        return [(0, 1)] if root[0] != root[1] and 100 * min(len(x), len(y)) >= PERCENT * max(len(x), len(y)) and len(np.intersect1d(x, y, assume_unique=True)) >= shared_least(len(x), len(y)) else []
    size = np.array([len(x) for x in sets])
    first = np.concatenate(([0], np.cumsum(size)))
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    mark, out = np.zeros(len(values), bool), []
    left = np.arange(len(sets))
    while len(left) > 1:
        reach, left = [int(left[0])], left[1:]
        taken: set[int] = set()
        while reach and len(left):
            at = reach.pop()
            if root[at] not in taken:
                taken.add(root[at])
                same = root[left] == root[at]
                reach.extend(left[same].tolist())
                left = left[~same]
            near = left[(100 * np.minimum(size[left], size[at]) >= PERCENT * np.maximum(size[left], size[at]))]
            if not len(near):
                continue
            own = code[first[at] : first[at + 1]]
            mark[own] = True
            n = size[near]
            end = np.cumsum(n)
            places = np.arange(end[-1]) + np.repeat(first[near] - (end - n), n)
            both = np.add.reduceat(mark[code[places]].astype(np.int32), end - n)
            mark[own] = False
            found = near[both >= shared_least(n, size[at])]
            if len(found):
                out += [(at, int(i)) for i in found]
                reach.extend(found.tolist())
                left = np.setdiff1d(left, found, assume_unique=True)
    return out


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, block) -> links inside each block of a list."""
    out: list[tuple[int, int]] = []
    for _, group in groupby(_each(batches, ["key", "block", "node", "root", "elements"]), lambda r: r[:2]):
        held = list({r[2]: r for r in group}.values())
        if len(held) > 1:
            nodes = [r[2] for r in held]
            out += [(nodes[a], nodes[b]) for a, b in forest([np.frombuffer(r[4], np.uint64) for r in held], np.array([r[3] for r in held]))]
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["u", "v"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["u", "v"])
    trim()


def _met(rows: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    """(key, block, node, root) with columns of the node's set, each block in one task and in a row."""
    return rows.join(sets.select("node", *columns), "node").repartition("key", "block").sortWithinPartitions("key", "block").select("key", "block", "node", "root", *columns)


def _compared(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, block, node, root) -> links, by the elements of the nodes."""
    return _met(rows, sets, ["elements"]).mapInArrow(_links, "u long, v long")


def _chunk(n: Column) -> Column:
    return F.ceil(n / MOST).cast("int")


def _spot(n: Column) -> Column:
    """A place under n that follows from the node."""
    return F.pmod(F.xxhash64("node"), n).cast("int")


def _first_round(members: DataFrame, lists: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of each set in its longest and its shortest list; of lists cut into chunks each has the list's least node."""
    picked = members.groupBy("node").agg(F.max(F.struct("c", "key")).alias("a"), F.min(F.struct("c", "key")).alias("b"))
    picked = picked.select("node", F.explode(F.array_distinct(F.array("a", "b"))).alias("x")).select("node", "x.*")
    rows = picked.select("key", _spot(_chunk(F.col("c"))).cast("string").alias("block"), "node")
    leaders = lists.filter(F.col("c") > MOST).select("key", F.explode(F.sequence(F.lit(0), _chunk(F.col("c")) - 1)).alias("block"), F.col("least").alias("node"))
    leaders = leaders.withColumn("block", F.col("block").cast("string"))
    return _compared(rows.unionByName(leaders).withColumn("root", F.col("node")), sets)


def _second_round(members: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of sets of different components in the lists that still have some; of lists with the same sets one is enough."""
    of = table(members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")), "jaccard-members")
    sums = of.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("x"))
    open_ = table(sums.filter("a < b").groupBy("n", "s", "x").agg(F.min("key").alias("key")).select("key", "n"), "jaccard-open")
    rows = table(of.join(open_, "key"), "jaccard-rows")
    drop(of)
    light = rows.filter(F.col("n") <= MOST).select("key", F.lit("").alias("block"), "node", "root")
    parts = rows.filter(F.col("n") > MOST).groupBy("key", "root").agg(F.count("*").alias("k"), F.first("n").alias("n"))
    parts = parts.groupBy("key").agg(F.max(F.struct("k", "root")).alias("m"), F.first("n").alias("n"))
    parts = table(parts.select("key", F.col("m.root").alias("main"), _chunk(F.col("m.k")).alias("mains"), _chunk(F.col("n") - F.col("m.k")).alias("rests")), "jaccard-parts")
    dealt = rows.filter(F.col("n") > MOST).join(parts, "key")
    name = lambda kind, a, b: F.concat_ws(":", F.lit(kind), a, b)
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    place = _spot(F.when(F.col("root") == F.col("main"), F.col("mains")).otherwise(F.col("rests")))
    dealt = dealt.withColumn("at", place)
    with_mains = F.transform(upto(F.col("mains")), lambda i: name("m", i, F.col("at")))
    with_rests = F.transform(upto(F.col("rests")), lambda j: name("r", F.least(j, F.col("at")), F.greatest(j, F.col("at"))))
    blocks = F.when(F.col("root") == F.col("main"), F.transform(upto(F.col("rests")), lambda j: name("m", F.col("at"), j))).when(F.col("rests") > 1, F.concat(with_mains, with_rests)).otherwise(with_mains)
    heavy = dealt.select("key", F.explode(blocks).alias("block"), "node", "root")
    suspects = _met(light.unionByName(heavy), sets, ["n", "sketch"]).mapInArrow(_suspects, "key long, block string, node long, root long")
    return _compared(table(suspects, "jaccard-suspects"), sets)


def prefixes(docs: DataFrame) -> DataFrame:
    """(doc_id, n, node, need, prefix). Elements in the prefixes of more than ``MOST`` sets by hash alone are heavy and come last."""
    texts, spark = texts_of(docs), docs.sparkSession
    schema = "doc_id long, n long, node long, need int, prefix array<long>"
    found = table(texts.mapInArrow(lambda batches: _prefixes(None, batches), schema), "jaccard-prefixes")
    often = found.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > MOST)
    often = table(often.select("key"), "jaccard-often")
    if often.isEmpty():
        return found
    late = spark.sparkContext.broadcast(bitmap(often, "key"))
    drop(found, often)
    return table(texts.mapInArrow(lambda batches: _prefixes(late.value, batches), schema), "jaccard-prefixes")


def _lists_of(entries: DataFrame) -> DataFrame:
    """The lists of two sets or more, with their number and the least of them."""
    return entries.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("least")).filter("c > 1")


def shared_lists(distinct: DataFrame, small: int) -> tuple[DataFrame, DataFrame]:
    """(key, node, c) of the sets in lists that others are in, too, and (key, c, least) of the lists.

    Large sets that are in fewer of them than they need are taken out, and then those that this leaves in too few.
    """
    entries = table(distinct.mapInArrow(lambda batches: _keys(small, batches), "key long, node long"), "jaccard-entries")
    lists = table(_lists_of(entries), "jaccard-lists")
    members = table(entries.join(lists, "key").select("key", "node", "c"), "jaccard-listed")
    drop(entries)
    needs = distinct.select("node", F.when(F.col("n") * PERCENT > 100 * small, F.col("need")).otherwise(1).alias("need"))
    for _ in range(_LEAVE):
        stay = members.groupBy("node").agg(F.count("*").alias("k")).join(needs, "node").filter("k >= need").select("node")
        left = table(members.join(stay, "node", "left_semi").select("key", "node"), "jaccard-entries")
        drop(members, lists)
        lists = table(_lists_of(left), "jaccard-lists")
        members = table(left.join(lists, "key").select("key", "node", "c"), "jaccard-listed")
        drop(left)
    return members, lists


def _boundary_of(sets: DataFrame) -> int:
    sizes = sets.filter("size(prefix) > 0").groupBy(size_class(F.col("n")).alias("k")).agg(F.count("*").alias("c"), F.avg("n").alias("n")).collect()
    lists = sets.select("n", F.explode("prefix").alias("key")).groupBy("key").agg(F.count("*").alias("c"), F.avg("n").alias("n"))
    pairs = lists.groupBy(size_class(F.col("n")).alias("k")).agg(F.sum(F.col("c").cast("double") * F.least(F.col("c") - 1, F.lit(MOST)) / 2).alias("p")).collect()
    return boundary({r["k"]: (r["c"], r["n"]) for r in sizes}, {r["k"]: r["p"] for r in pairs})


def similar(docs: DataFrame, small: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id that links lead to. ``small``: the boundary, by default that of least cost."""
    found = prefixes(docs)
    distinct = table(found.filter("size(prefix) > 0").select("node", "n", "need", "prefix").dropDuplicates(["node"]), "jaccard-sets")
    members, lists = shared_lists(distinct, _boundary_of(distinct) if small is None else small)
    drop(distinct)
    live = docs.sparkSession.sparkContext.broadcast(bitmap(members, "node"))
    sets = texts_of(docs).mapInArrow(lambda batches: _whole(live.value, batches), "node long, n int, sketch binary, elements binary")
    sets = table(sets.dropDuplicates(["node"]), "jaccard-elements")
    roots = stars(_first_round(members, lists, sets))
    more = _second_round(members, roots.select(F.col("u").alias("node"), F.col("v").alias("root")), sets)
    roots = stars(more.unionByName(roots)).select(F.col("u").alias("node"), F.col("v").alias("root"))
    drop(members, lists, sets)
    own = table(found.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least")).join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "jaccard-classes")
    least = own.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = table(own.join(least, "root").select("node", "component_id"), "jaccard-components")
    linked = found.filter("n > 0").select("doc_id", F.col("n").alias("n_shingles"), "node").join(classes, "node").select("doc_id", "n_shingles", "component_id")
    alone = found.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


#: DuckDB SQL over the table documents: every pair that shares a shingle, counted.
ORACLE = rf"""with recursive w as (select doc_id, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
s as materialized (select distinct doc_id, md5(g) as g from (select doc_id, unnest(case when len(ws) < {SHINGLE} then [array_to_string(ws, ' ')] else list_transform(range(1, len(ws) - {SHINGLE - 2}), lambda i: array_to_string(ws[i:i + {SHINGLE - 1}], ' ')) end) as g from w where len(ws) > 0)),
n as materialized (select doc_id, count(*) as n, md5(string_agg(g, '' order by g)) as name from s group by doc_id),
c as materialized (select name, min(doc_id) as rep, any_value(n) as n from n group by name),
r as materialized (select s.doc_id, g from s join c on s.doc_id = c.rep),
often as materialized (select g from r group by g having count(*) > 1),
q as materialized (select * from r semi join often using (g)),
link as materialized (select a.doc_id as u, b.doc_id as v from q a join q b on a.g = b.g and a.doc_id <> b.doc_id join c x on x.rep = a.doc_id join c y on y.rep = b.doc_id
  where 100 * least(x.n, y.n) >= {PERCENT} * greatest(x.n, y.n) group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= {PERCENT} * (x.n + y.n - count(*))),
far as (select rep as u, rep as v from c union select far.u, link.v from far join link on far.v = link.u),
least_ as (select u, min(v) as component_id from far group by u)
select documents.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(component_id, documents.doc_id) as component_id
from documents left join n using (doc_id) left join c using (name) left join least_ on least_.u = c.rep"""
